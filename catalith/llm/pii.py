"""Personal information in free text: high-recall candidates, gradient-boosted trees over format and context, calibrated thresholds."""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalith.llm.labelled_pii import GIVEN_NAMES, PRODUCT_NAMES, SENTENCES, examples
from catalith.runtime import bounded_rows, ship_package

KINDS = ["email", "phone", "id_number", "address", "person"]
#: Weight of recall against precision in the F score by which thresholds are chosen.
BETA = 0.5
#: Loss of F score put up with for a lower threshold, which differs little from run to run of the folds.
PLATEAU = 0.01
#: Parts the labelled sentences are cut into; each part is scored by trees trained on the others.
FOLDS = 4

_UP = r"(?:\p{Lu}['’](?=\p{Lu}\p{Ll}))?\p{Lu}[\p{Ll}\p{M}]+(?:['’]?\p{Lu}[\p{Ll}\p{M}]+)?(?:-\p{Lu}[\p{Ll}\p{M}]+)*"
_GAP = r"[ \xa0\u202f]"
_TOWN = rf"(?:(?:San|Santa|Saint|Sankt|Bad|St\.|New|Los|Las|Le|La|El|Den|The|São|Rio|Port|Fort|West|East|North|South|Great|Upper|Lower){_GAP})?{_UP}(?:{_GAP}(?:am|an{_GAP}der|ob{_GAP}der|im|sur|upon|on|de|del|de{_GAP}la|sul|aan{_GAP}den){_GAP}{_UP})?"
_BREAK = r"(?:,?[ \xa0\u202f]*\r?\n[ \t>*-]*|,[ \xa0\u202f]+)"
_NO = r"\d{1,5}(?:[ ]?(?:bis|ter)\b|[A-Za-z]\b|[-/]\d{1,4}\b)?"
_CODE = rf"(?:[A-Z]{{1,2}}-)?\d{{4,5}}(?:-\d{{3,4}})?(?:{_GAP}[A-Z]{{2}}(?=[ ]))?"
_TAIL = rf"{_BREAK}(?:{_CODE}{_GAP}{_TOWN}|\d{{2}}-\d{{3}}{_GAP}{_TOWN}|{_TOWN}(?:,?{_GAP}(?:(?:[A-Z]{{2}}|NSW|VIC|QLD|TAS|ACT){_GAP})?(?:\d{{4,5}}(?:-\d{{4}})?\b|[A-Z]{{1,2}}\d[\dA-Z]?{_GAP}\d[A-Z]{{2}}\b))?)"
_COMPASS = r"(?:N|S|E|W|NE|NW|SE|SW|North|South|East|West)"
# Words that make a street, by the way a language builds street names.
_STREET_AFTER = r"Street|St\.?|Lane|Ln\.?|Road|Rd\.?|Avenue|Ave\.?|Drive|Dr\.?|Court|Ct\.|Way|Close|Terrace|Place|Pl\.|Square|Sq\.|Boulevard|Blvd\.?|Row|Hill|Gardens|Crescent|Cres\.?|Parkway|Pkwy\.?|Highway|Hwy\.?|Trail|Circle|Cir\.|Loop|Alley|Mews|Grove|Walk|Quay|Wharf|Plaza"
_STREET_END = r"straße|strasse|str\.|weg|gasse|platz|allee|ufer|ring|damm|steig|hof|markt|graben|straat|laan|plein|gracht|kade|dijk|gatan|vägen|vej|gade"
_STREET_BEFORE = r"Calle|C/|Avenida|Avda\.|Av\.|Plaza|Paseo|Camino|Carrera|Ronda|Travesía|Via|Viale|Piazza|Corso|Largo|Vicolo|Rua|Travessa|Praça|Largo|ul\.|ulica|al\.|Carrer"
_STREET_NUMBERED = r"rue|avenue|boulevard|place|chemin|impasse|allée|quai|route|cours|square|passage|Rue|Avenue|Boulevard|Place|Quai"
_OF = rf"(?:de{_GAP}la|de{_GAP}los|de{_GAP}las|dell['’]|degli|della|delle|dei|del|dos|das|des|du|de{_GAP}l['’]|d['’]|do|da|de|di|la|el)"
_BOX = r"P\.?[ ]?O\.?[ ]?Box|Postfach|Apartado(?:[ ]de[ ]Correos)?|Boîte[ ]postale|BP|Postbus|Casella[ ]postale"


_ENDS = (*(e.replace("\\", "") for e in _STREET_END.split("|")), "Straße", "Strasse", "Str.", "Weg", "Platz", "Allee")
_BEFORE_NUMBER = re.compile(r"[ \xa0]\d")


#: Six digits close together, as every number of a kind holds, or a code of letters and digits.
_six_digits = re.compile(r"\d(?:[^\d\n]{0,3}\d){5}|[A-Z]\d\d[\dA-Z]{6}").search


def _numbered_street(text: str) -> bool:
    """Whether a number follows a word that ends like a street, or a word behind Am, Im and the like."""
    for m in _BEFORE_NUMBER.finditer(text):
        at = m.start()
        i = max(text.rfind(" ", 0, at), text.rfind("\n", 0, at))
        if text.endswith(_ENDS, i + 1, at) or (i > 0 and text.endswith(("Am", "Im", " der", " dem", " den"), max(0, i - 4), i)):
            return True
    return False


def _words_of(alternatives: str, before: str = "", after: str = "") -> list[str]:
    return [before + re.sub(r"\\\.\??$|\\", "", a) + after for a in alternatives.split("|")]


#: Words that make a street, but for those that end in one: a text without any holds no such address.
_STREETS = ahocorasick.Automaton()
for _word in [*_words_of(_STREET_AFTER, " "), *_words_of(_STREET_BEFORE, after=" "), *_words_of(_STREET_NUMBERED, " ", " "), "Box ", "Postfach ", "Apartado", "postale ", "BP ", "Postbus "]:
    _STREETS.add_word(_word, True)
_STREETS.make_automaton()


def _street(text: str) -> bool:
    """Whether a text holds a word that makes a street."""
    return next(_STREETS.iter(text), None) is not None


#: (kind, cheap test that holds for every text with a match, pattern).
_PATTERNS = [
    ("phone", _six_digits, re.compile(r"(?<![\w/.,-])(?:\+\d{1,3}|\(\d{2,5}\)|\d{2,5}|\d)(?:(?:[ \xa0\u202f]?\(\d{1,4}\)[ \xa0\u202f-]?|[ \xa0\u202f./-])?\d+)+(?![\w-]|[.,]\d)")),
    ("id_number", _six_digits, re.compile(r"(?<![\w-])(?=[A-Z]{0,2}[- ]?\d)(?:\d{3}[- ]\d{2}[- ]\d{4}|[A-Z]{1,2}\d{6,9}[A-Z]?|[A-Z]{2}(?:[ ]\d{2}){3}[ ][A-Z]|\d{8}-?[A-Z]|[XYZ]-?\d{7}-?[A-Z]|[12][ ]?\d{2}[ ]?\d{2}[ ]?\d[\dAB][ ]?\d{3}[ ]?\d{3}(?:[ ]?\d{2})?|\d{2} \d{3} \d{3} \d{3}|\d{11}|\d{2,3}/\d{3}/\d{4,5}|[A-Z]{2}\d{2}(?:[ ]?[\dA-Z]{4}){3,7}(?:[ ]?[\dA-Z]{1,3})?|[A-Z]\d{2}[\dA-Z]{6}\d?|\d{3}-\d{2}-\d{2}|\d{3}[ ]\d{3}[ ]\d{3}|\d{6}[-+]\d{3,4}[A-Z]?|\d{3}\.\d{3}\.\d{3}-\d{2}|[A-Z]{4}\d{6}[A-Z\d]{3,8}|\d{4}[ ]\d{4}[ ]\d{4})(?![\w-])")),
    ("address", _street, regex.compile(rf"(?<![\w.,-]){_NO}{_GAP}(?:{_COMPASS}\.?{_GAP})?(?:(?:{_UP}|\d{{1,3}}(?:st|nd|rd|th)){_GAP}){{1,3}}(?:{_STREET_AFTER})(?!\w)(?:{_GAP}{_COMPASS}(?!\w))?(?:,?{_GAP}(?:Apt\.?|Flat|Unit|Suite|Ste\.?|No\.|Floor|\#){_GAP}?\w+)?(?:{_TAIL})?")),
    ("address", _numbered_street, regex.compile(rf"(?<![\w])(?:{_UP}{_GAP})?(?:\p{{Lu}}[\p{{Ll}}-]*(?:{_STREET_END})|(?:{_UP}-)+(?:Straße|Strasse|Str\.|Weg|Platz|Allee)|(?:Am|Im|An{_GAP}der|Auf{_GAP}dem|Unter{_GAP}den){_GAP}{_UP}){_GAP}{_NO}(?:{_TAIL})?")),
    ("address", _street, regex.compile(rf"(?<![\w])(?:{_STREET_BEFORE}){_GAP}(?:{_OF}(?:{_GAP})?)?{_UP}(?:{_GAP}(?:{_OF}{_GAP})?{_UP})?,?{_GAP}(?:n[º°.]{_GAP}?)?{_NO}(?:{_TAIL})?")),
    ("address", _street, regex.compile(rf"(?<![\w]){_NO},?{_GAP}(?:{_STREET_NUMBERED}){_GAP}(?:{_OF}(?:{_GAP})?)?{_UP}(?:{_GAP}(?:{_OF}{_GAP})?{_UP})?(?:{_TAIL})?")),
    ("address", _street, regex.compile(rf"(?<![\w])(?:{_BOX}){_GAP}\d{{1,6}}(?:{_TAIL})?")),
]
_AT_BRACKETS = re.compile(r" ?[\[({<] ?(?:at|AT|ät|arroba|chez) ?[\])}>] ?")
_AT_WORDS = re.compile(r" (?:at|AT) (?=[\w-]+ (?:dot|DOT) )")
_MAIL_HOST = re.compile(r"[\w-]+(?:(?:\.| ?[\[({<] ?(?:dot|DOT|punkt|punto|point) ?[\])}>] ?| (?:dot|DOT) )[\w-]+)+")
_NAME_WORD = regex.compile(rf"{_UP}|\p{{Lu}}\.|\p{{Lu}}{{2,}}(?:-\p{{Lu}}{{2,}})*")
_DIGIT = re.compile(r"\d")
_WORD = re.compile(r"\w+(?:['’]\w+)?|\n|[^\w\s]")

# Words that stand between the parts of a name.
PARTICLES = {"de", "da", "do", "dos", "das", "del", "della", "di", "van", "von", "der", "den", "ten", "ter", "la", "le", "el", "al", "bin", "ibn", "y", "zu", "zum", "af", "av", "of"}
# Function words and words of shops that are part of no name; a name ends before them.
NO_NAMES = set(
    """The This That These Those There It Its In On At By For From With Without And But Or If Is Are Was Were Would Could Can Might Do Does Did Not No Yes My Your Our His Her Their We You He She They I An A
    Please Thanks Thank Hello Dear Regards Kind Yours Order Lot Batch Sample Item Text Call Each Every Take Keep Read Store Use Suggested Reviewed Signed Sent Ask Even Last Next After Before Once Only Compared Honestly Update
    Contains Content Result Loss Particle Retained Label Many Most Much Measuring Growers Authors About Supplement Facts Serving Size Manufactured Other Ingredients Daily Value How What Where Which When Who Why
    Der Die Das Den Dem Ein Eine Ich Wir Sie Er Es Mein Meine Bitte Viele Grüße Grüßen Laut Nach Für Im Am Würde Tel Telefonisch Antwort Erreichbar
    El La Le Los Las Lo Un Una Mi Su Me Les Des Du De Ce Cette Ma Mon Je Tu Il Elle Nous Vous Tomo Llámenme Envíenlo Volvería Saludos Firmado Signé Cordialement Merci Appelez Adresse Numéro
    Street Road Avenue Ave Apt Flat Unit Suite Calle Avenida Plaza Rue Box
    Oil Acid Extract Vitamin Capsules Capsule Tablets Tablet Gummies Gummy Bites Softgels Gels Lozenges Lozenge Caps Tabs Vcaps Powder Blend Labs Naturals Nutrition Wellness Botanics Essentials Softgel Vitamins Minerals
    Billion Million Energy Protein Team Edition""".split()
)
# Capitalised words that are names as well as words of other use; the trees weigh them.
COMMON = set(
    """Will May April June August January February March July September October November December Monday Tuesday Wednesday Thursday Friday Saturday Sunday Januar Februar März Mai Juni Juli Oktober Dezember Montag Dienstag Mittwoch Donnerstag Freitag Samstag Sonntag
    White Black Green Brown Grey Gray Blue Red Gold Silver Lane Court Square Drive Park Hill Prime Best Pharmacy Store Shop Times Sleep Skin Hair Tea Fish Krill Seed Vegetable Chewable Coated Liquid Melt Soft Grand Central Main North South East West New Royal""".split()
)
TITLES = {"mr", "mrs", "ms", "miss", "dr", "prof", "frau", "herr", "madame", "monsieur", "mme", "señora", "señor", "sra", "sr", "doña", "don", "signor", "signora", "mevrouw", "meneer", "sir", "lady"}
_TITLE_FORMS = {t.capitalize() for t in TITLES} - {"Don"}
# Last words before a name that stands alone: of letters that begin, and, before a comma, colon or line break, of letters that end.
GREETINGS = {"hi", "hello", "dear", "hola", "liebe", "lieber", "cher", "chère", "caro", "ciao"} | TITLES
CLOSINGS = {"regards", "cheers", "sincerely", "signed", "yours", "grüßen", "grüße", "cordialement", "saludos", "saludo", "signé", "firmado", "thanks"}
CUES = GREETINGS | CLOSINGS
# How many surnames end, and begin.
SURNAME_ENDS = tuple("son sen mann man berg burg stein bach dorf hoff ström lund gren dahl quist qvist ov ova ev eva ski sky ska enko chuk ić ez ini elli etti ucci ino opoulou opoulos idis akis yan ian oğlu ford ton ham ley well worth field wood stone brook hurst ard eau ier dt tz sch er ner ova ов ова ев ева ко ίου ου".split())
SURNAME_STARTS = ("Mc", "Mac", "O'", "O’", "D'", "Fitz")
# Words before and behind the names of persons.
PERSON_BEFORE = set("by contact customer attn attention patient recipient holder cc sister brother husband wife friend friends neighbour neighbor colleague mother father daughter son met told ask asked spoke talked according name named called laut frau mann schwester bruder kollegin kollege freundin freund kundin kunde ansprechpartner bestellt según nombre hermana hermano amiga amigo llamo llama selon nom mari femme soeur frère ami amie appelle signore naam heet".split())
PERSON_AFTER = set("wrote writes said says told called rang phoned noticed asked opened sent signed tried likes uses took takes answered replied complained met schrieb sagte rief hat nahm bestellte atendió ayudó dijo escribió llamó conseillée conseillé répondu dit écrit appelé ouvert ha schreef zei".split())
# Words near a number that tell what it is.
NUMBER_CUES = {
    "phone": set("call calls called phone telephone tel tél mobile cell ring rang text sms fax whatsapp dial number reach reached contact hotline handy mobil telefon telefonisch rufen erreichbar erreichen anrufen llame llámenme llamar teléfono teléfono móvil appelez appeler téléphone portable joindre telefono chiamare bel ph".split()),
    "id": set("passport pasaporte passeport reisepass ssn social security insurance national ni id identity dni nif nie nir steuer steuernummer tax personalausweis ausweis ausweisnummer licence license iban driver sécurité sociale cédula codice fiscale bsn personnummer pesel cpf".split()),
    "goods": set("order orders lot batch item items gtin ean upc sku qty price invoice tracking article model serial part isbn charge chargennummer lote lots sample version study ran ref reference bestellung bestellnummer artikel artikelnummer pedido commande facture factura rechnung code bin shelf issue page parcel shipment version release patent formula".split()),
}
_GIVEN = {g.lower() for g in GIVEN_NAMES}


@dataclass(frozen=True)
class Lexicon:
    """Words of product names in lower case, which the trees weigh, and their pairs of neighbouring words, which are no persons."""

    words: frozenset[str] = frozenset()
    pairs: frozenset[str] = frozenset()


def lexicon(names: list[str]) -> Lexicon:
    """The lexicon of a list of product names."""
    words, pairs = set(), set()
    for name in names:
        found = [w.lower() for w in regex.findall(r"\p{L}{3,}", name or "")]
        words.update(found)
        pairs.update(f"{a} {b}" for a, b in zip(found, found[1:], strict=False))
    return Lexicon(frozenset(words), frozenset(pairs))


@dataclass(frozen=True)
class Candidate:
    start: int
    end: int
    kind: str


_ANY_CUE = CUES | {"is", "ist", "est", "es"}
_CUE = re.compile(r"(\w+)(?:(\.)[ \xa0]|([,:]?\s+))$")


def _cued(text: str, at: int) -> bool:
    """Whether the word just before a place is a cue, with a comma, colon or line break between at most, or a title with a point."""
    if text[at - 2 : at] in ("! ", "? ", "; ", ") ") or (text[at - 2 : at] == ". " and " " not in text[max(0, at - 8) : at - 2] and at > 8):
        return False
    left = text[max(0, at - 20) : at].rstrip(" ,:.\r\n\t\xa0").lower()
    if left[max(left.rfind(" "), left.rfind("\n"), left.rfind("\xa0")) + 1 :] not in _ANY_CUE:
        return False
    m = _CUE.search(text, max(0, at - 40), at)
    if m is None:
        return False
    word = m.group(1).lower()
    if m.group(2):
        return word in TITLES and not m.group(1).isupper()
    if m.group(3) != " " and word in CLOSINGS:
        return True
    return (word in GREETINGS and not m.group(1).isupper()) or (word in ("is", "ist", "est", "es") and text[max(0, m.start() - 5) : m.start()].strip().lower() in ("name", "nom"))


def _plain(word: str) -> bool:
    return word not in NO_NAMES and word not in _TITLE_FORMS and not (word.isupper() and word.capitalize() in NO_NAMES)


def _name_candidates(text: str, known: Lexicon) -> Iterator[Candidate]:
    """Runs of two to four capitalised words, also with initials or particles between them or a comma after the first, from every word on; and a single
    word after a greeting, a title or the like. Words of NO_NAMES and pairs of product words end a run."""
    words = [(m.start(), m.end(), m.group()) for m in _NAME_WORD.finditer(text)]
    for i, (start, end, word) in enumerate(words):
        if (i + 1 == len(words) or words[i + 1][0] - end > 12) and not _cued(text, start):
            continue
        if not _plain(word):
            continue
        if (start and (text[start - 1].isalnum() or text[start - 1] in "-_'’@.")):
            continue
        at, last, n = end, word, 1
        alone = len(word) > 2 and (end == len(text) or not (text[end].isalnum() or text[end] in "_@"))
        for j in range(i + 1, min(i + 6, len(words))):
            s, e, w = words[j]
            gap = text[at:s]
            comma = j == i + 1 and gap == ", " and len(word) > 2
            if not _plain(w) or (e < len(text) and (text[e].isalnum() or text[e] in "_@")) or n == 4:
                break
            if not comma and gap not in (" ", "\xa0", "\u202f") and not (len(gap) < 12 and gap[:1] == " " and gap[-1:] == " " and all(p in PARTICLES for p in gap.split())):
                break
            if known.pairs and f"{last.lower()} {w.lower()}" in known.pairs:
                break
            at, last = e, w
            if len(w.rstrip(".")) > 1:
                n += 1
                yield Candidate(start, e, "person")
        if n == 1 and alone and word[1:].islower() and _cued(text, start):
            yield Candidate(start, end, "person")


def _mail_candidates(text: str) -> Iterator[Candidate]:
    """Addresses around each @ or written-out at: the sign is found first, then what stands before and behind it."""
    found = []
    at = text.find("@")
    while at >= 0:
        found.append((at - (text[at - 1 : at] == " "), at + 1 + (text[at + 1 : at + 2] == " ")))
        at = text.find("@", at + 1)
    if "[" in text or "(" in text or "{" in text or "<" in text:
        found += [m.span() for m in _AT_BRACKETS.finditer(text)]
    if " dot " in text or " DOT " in text:
        found += [m.span() for m in _AT_WORDS.finditer(text)]
    for left, right in found:
        start = left
        while start and (text[start - 1].isalnum() or text[start - 1] in "_.+%'-"):
            start -= 1
        while start < left and not (text[start].isalnum() or text[start] == "_"):
            start += 1
        host = _MAIL_HOST.match(text, right)
        if start < left and host:
            yield Candidate(start, host.end(), "email")


def _phone_candidates(at: int, value: str) -> Iterator[Candidate]:
    """The whole run of digit groups and its beginnings that end before a blank, of 7 to 15 digits each."""
    if len(value) < 7:
        return
    ends = [len(value), *(m.start() for m in re.finditer(r"[ \xa0\u202f]", value))]
    for end in ends:
        if 7 <= sum(c.isdigit() for c in value[:end]) <= 15 and value[end - 1].isdigit():
            yield Candidate(at, at + end, "phone")


def candidates(text: str, known: Lexicon = Lexicon()) -> list[Candidate]:
    """Overlapping spans that may be personal information, with high recall."""
    if not text or text.isspace():
        return []
    found = [*_name_candidates(text, known), *_mail_candidates(text)]
    if not _DIGIT.search(text):
        return found
    tried: dict[Callable, object] = {}
    for kind, needs, pattern in _PATTERNS:
        if needs not in tried:
            tried[needs] = needs(text)
        if not tried[needs]:
            continue
        if kind == "phone":
            found += [c for m in pattern.finditer(text) for c in _phone_candidates(m.start(), m.group())]
        elif kind == "address":
            found += [Candidate(m.start(), m.end(), kind) for m in pattern.finditer(text, overlapped=True)]
        else:
            found += [Candidate(m.start(), m.end(), kind) for m in pattern.finditer(text)]
    return found


_CAPITAL_LEFT, _CAPITAL_RIGHT = regex.compile(rf"\p{{Lu}}[\p{{L}}.]*{_GAP}$"), regex.compile(rf"{_GAP}\p{{Lu}}")
_TITLE_BEFORE = re.compile(r"(?<!\w)(?:" + "|".join(sorted({*TITLES, *(t.capitalize() for t in TITLES)})) + r")\.?\s$")
_PARTS = re.compile(r",?[ \xa0\u202f]")


def features(text: str, c: Candidate, known: Lexicon = Lexicon()) -> list[str]:
    """Names of a candidate's format and context features that hold."""
    value = text[c.start : c.end]
    before, after = _WORD.findall(text[max(0, c.start - 48) : c.start].lower())[-4:], _WORD.findall(text[c.end : c.end + 32].lower())[:2]
    k = c.kind
    out = [k]
    for i, w in enumerate(reversed(before[-3:])):
        out.append(f"{k} b{i}={'#' if w.isdigit() else w}")
    if len(before) > 1:
        out.append(f"{k} bb={before[-2]} {before[-1]}")
    near = set(before)
    out += [f"{k} in={w}" for w in near if w.isalpha()]
    if k in ("phone", "id_number"):
        out += [f"{k} near {what}" for what, words in NUMBER_CUES.items() if not words.isdisjoint(near)] + [f"{k} then {what}" for what, words in NUMBER_CUES.items() if not words.isdisjoint(after)]
    for i, w in enumerate(after):
        out.append(f"{k} a{i}={'#' if w.isdigit() else w}")
    if k == "person":
        words = [w for w in _PARTS.split(value) if w not in PARTICLES]
        low = [w.lower() for w in words]
        given = [any(p in _GIVEN for p in w.split("-")) for w in low]
        listed = [any(p in known.words for p in w.split("-")) for w in low]
        out += [f"p n={len(words)}"] + ["p comma"] * ("," in value) + ["p given"] * any(given) + ["p first given"] * given[0] + ["p first only given"] * (given[0] and not any(given[1:]) and not any(listed)) + ["p last given"] * given[-1] + ["p middle given"] * any(given[1:-1]) + ["p particle"] * (len(words) < len(_PARTS.split(value)))
        out += ["p product"] * any(listed) + ["p all product"] * all(listed) + ["p last product"] * listed[-1] + ["p then lower"] * bool(after and after[0].isalpha() and text[c.end + 1 : c.end + 2].islower()) + ["p common"] * any(w in COMMON for w in words) + ["p all common"] * all(w in COMMON for w in words)
        ends = words[0 if "," in value else -1]
        surname = ends.lower().endswith(SURNAME_ENDS) or (ends.startswith(SURNAME_STARTS) and ends not in ("Mac",))
        out += ["p surname"] * surname + ["p given and surname"] * (surname and any(given)) + ["p given, surname, no product"] * (surname and any(given) and not any(listed))
        out += ["p initial"] * (len(words[0]) == 2 and words[0][1] == ".") + ["p middle"] * any(len(w) == 2 and w[1] == "." for w in words[1:]) + ["p upper"] * value.isupper()
        out += ["p title before"] * bool(_TITLE_BEFORE.search(text, max(0, c.start - 12), c.start)) + ["p cue before"] * bool(CUES.intersection(before[-3:]))
        out += ["p person before"] * (not PERSON_BEFORE.isdisjoint(before[-2:])) + ["p person after"] * (not PERSON_AFTER.isdisjoint(after))
        left, right = text[max(0, c.start - 30) : c.start], text[c.end : c.end + 2]
        out += ["p capital left"] * bool(_CAPITAL_LEFT.search(left)) + ["p capital right"] * bool(_CAPITAL_RIGHT.match(right)) + ["p line start"] * (not left.strip(" ") or left.rstrip(" ").endswith("\n"))
    elif k == "phone":
        groups = re.findall(r"\d+", value)
        n = sum(map(len, groups))
        out += [f"t digits={min(n, 16)}", f"t groups={len(groups)}", f"t longest={max(map(len, groups))}", f"t shape={re.sub(r'[0-9]', '9', value)}"]
        out += ["t plus"] * value.startswith("+") + ["t zero"] * value.startswith("0") + ["t paren"] * value.startswith("(") + ["t nine"] * value.startswith("9") + [f"t sep={s}" for s in set(re.findall(r"[^\d]", value))]
        out += ["t date"] * bool(re.fullmatch(r"(?:19|20)\d\d-\d\d-\d\d|\d\d[./]\d\d[./](?:19|20)?\d\d", value)) + ["t ssn"] * bool(re.fullmatch(r"\d{3}[- ]\d\d[- ]\d{4}", value)) + ["t balanced"] * (value.count("(") == value.count(")"))
        out += ["t more right"] * (text[c.end : c.end + 1] in (" ", "\xa0") and text[c.end + 1 : c.end + 2].isdigit())
    elif k == "id_number":
        shape = re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", value))
        out += [f"i shape={shape}", f"i digits={sum(ch.isdigit() for ch in value)}", *["i letter"] * any(ch.isalpha() for ch in value)]
    elif k == "address":
        out += ["d town"] * bool(re.search(r"[,\n]", value)) + ["d code"] * bool(re.search(r"\d{4,5}$|\d{4,5} ", value)) + ["d break"] * ("\n" in value) + ["d number"] * value[0].isdigit()
    return out


class BoostedTrees:
    """Gradient boosting of shallow trees on yes/no features, logistic loss; a numpy implementation of a few dozen lines, trained here."""

    def __init__(self, trees: int = 120, depth: int = 4, rate: float = 0.2, least: int = 3, penalty: float = 1.0) -> None:
        self.n, self.depth, self.rate, self.least, self.penalty = trees, depth, rate, least, penalty

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        """Fit on 0/1 matrix x and labels y; sums of a level are taken over the ones of the matrix only."""
        n, d = x.shape
        at_row, at_col = np.nonzero(x)
        self.base = float(np.log((y.sum() + 1) / (n - y.sum() + 1)))
        score, self.trees = np.full(n, self.base), []
        for _ in range(self.n):
            p = 1 / (1 + np.exp(-score))
            g, h = y - p, np.maximum(p * (1 - p), 1e-6)
            split, value = np.full(2**self.depth - 1, -1), np.zeros(2 ** (self.depth + 1) - 1)
            node = np.zeros(n, int)
            for level in range(self.depth + 1):
                first, width = 2**level - 1, 2**level
                here = node - first
                live = here >= 0
                gs, hs, ns = (np.bincount(here[live], w[live], width) for w in (g, h, np.ones(n)))
                value[first : first + width] = self.rate * gs / (hs + self.penalty)
                if level == self.depth:
                    break
                ones = live[at_row]
                key = here[at_row[ones]] * d + at_col[ones]
                g1, h1, n1 = (np.bincount(key, w[at_row[ones]], width * d).reshape(width, d) for w in (g, h, np.ones(n)))
                rest = hs[:, None] - h1 + self.penalty
                gain = g1**2 / (h1 + self.penalty) + (gs[:, None] - g1) ** 2 / rest - (gs**2 / (hs + self.penalty))[:, None]
                gain[(n1 < self.least) | (ns[:, None] - n1 < self.least)] = 0
                best = gain.argmax(1)
                good = gain[np.arange(width), best] > 1e-3
                split[first : first + width] = np.where(good, best, -1)
                moving = live & good[np.maximum(here, 0)]
                node[moving] = 2 * node[moving] + 1 + x[np.nonzero(moving)[0], best[here[moving]]].astype(int)
            self.trees.append((split, value))
            score += value[node]
        return self

    def score(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row."""
        total = np.full(len(x), self.base)
        for split, value in self.trees:
            node = np.zeros(len(x), int)
            for _ in range(self.depth):
                s = np.where(node < len(split), split[np.minimum(node, len(split) - 1)], -1)
                go = s >= 0
                node[go] = 2 * node[go] + 1 + x[go, s[go]].astype(int)
            total += value[node]
        return total


class Model:
    """Names of the features the trees ask for, boosted trees, calibration (scale, shift) and accepted threshold of each kind."""

    def __init__(self, names: dict[str, int], trees: BoostedTrees, calibration: tuple[float, float], thresholds: dict[str, float]) -> None:
        self.names, self.trees, self.calibration, self.thresholds = names, trees, calibration, thresholds

    def matrix(self, rows: list[list[str]]) -> np.ndarray:
        x = np.zeros((len(rows), len(self.names)), bool)
        at = [(i, j) for i, row in enumerate(rows) for f in row if (j := self.names.get(f)) is not None]
        if at:
            i, j = zip(*at, strict=True)
            x[list(i), list(j)] = True
        return x

    def probability(self, rows: list[list[str]]) -> np.ndarray:
        """Calibrated probability of each candidate, given its features."""
        a, b = self.calibration
        return 1 / (1 + np.exp(-(a * self.trees.score(self.matrix(rows)) + b))) if rows else np.zeros(0)


def _fit(rows: list[list[str]], y: np.ndarray, least: int) -> Model:
    """Trees on these candidates, without calibration; only the features they ask for are kept."""
    counts = Counter(f for row in rows for f in set(row))
    names = {f: i for i, f in enumerate(sorted(f for f, n in counts.items() if n >= least))}
    model = Model(names, BoostedTrees(), (1.0, 0.0), dict.fromkeys(KINDS, 0.5))
    model.trees.fit(model.matrix(rows), y)
    asked = sorted({int(i) for split, _ in model.trees.trees for i in split if i >= 0})
    place = {old: new for new, old in enumerate(asked)}
    model.trees.trees = [(np.array([place.get(int(i), -1) for i in split]), value) for split, value in model.trees.trees]
    ordered = list(names)
    model.names = {ordered[old]: new for old, new in place.items()}
    return model


def train(sentences: list[str] = SENTENCES, copies: int = 16, least: int = 4, folds: int = FOLDS) -> Model:
    """Train on labelled sentences.

    Sentences are parted into folds; the candidates of a fold's sentences are scored by trees trained on the other sentences, and on these scores the
    calibration (Platt) and the threshold of each kind by F score are found, overlapping candidates resolved. The trees kept are trained on all.
    """
    known = lexicon(PRODUCT_NAMES[::2])  # the other half are products no list names
    rows: list[list[str]] = []
    y, fold, texts, spotted = [], [], [], []
    for n in range(folds):
        for m, (text, spans) in enumerate(examples(sentences[n::folds], copies=copies, seed=7 + n)):
            marked = set(spans)
            for c in candidates(text, known):
                rows.append(features(text, c, known))
                y.append(float((c.start, c.end, c.kind) in marked))
                spotted.append(c)
                fold.append(n)
                texts.append((n, m))
    t, part = np.array(y), np.array(fold)
    s = np.zeros(len(rows))
    for n in range(folds):
        held = part == n
        model = _fit([r for r, h in zip(rows, held, strict=True) if not h], t[~held], least)
        s[held] = model.trees.score(model.matrix([r for r, h in zip(rows, held, strict=True) if h]))
    a, b = 1.0, 0.0
    for _ in range(300):
        p = 1 / (1 + np.exp(-(a * s + b)))
        a, b = a - 0.05 * float(((p - t) * s).mean()), b - 0.05 * float((p - t).mean())
    model = _fit(rows, t, least)
    model.calibration = (a, b)
    p = 1 / (1 + np.exp(-(a * s + b)))
    by_text: dict[tuple[int, int], list[int]] = {}
    for i, key in enumerate(texts):
        by_text.setdefault(key, []).append(i)
    left = [i for members in by_text.values() for i in _apart([(float(p[i]), spotted[i], i) for i in members])]
    for kind in KINDS:
        mine = np.array([i for i in left if spotted[i].kind == kind])
        model.thresholds[kind] = _threshold(p[mine], t[mine])
    return model


def _threshold(p: np.ndarray, right: np.ndarray) -> float:
    """The lowest threshold whose F score (BETA) is within PLATEAU of the greatest: halfway between the last candidate accepted and the next one below, or zero."""
    order = np.argsort(-p, kind="stable")
    p, hits = p[order], np.cumsum(right[order])
    if not len(p) or not hits[-1]:
        return 1.0
    f = (1 + BETA**2) * hits / (np.arange(1, len(p) + 1) + BETA**2 * hits[-1])
    at = int(np.nonzero(f >= f.max() - PLATEAU)[0][-1])
    return float((p[at] + (p[at + 1] if at + 1 < len(p) else 0.0)) / 2)


def _apart(found: list[tuple[float, Candidate, int]]) -> list[int]:
    """Those of the scored candidates of a text that are kept where they overlap: mail and postal addresses first, then surer ones, longer ones of equally sure."""
    taken: list[tuple[Candidate, int]] = []
    for _, c, i in sorted(found, key=lambda f: (_RANK[f[1].kind] > 1, -round(f[0], 3 if f[1].kind == "person" else 1), -(f[1].end - f[1].start), f[1].start)):
        if all(c.end <= o.start or c.start >= o.end for o, _ in taken):
            taken.append((c, i))
    return [i for _, i in taken]


@functools.cache
def default_model() -> Model:
    """The model of the library's labelled sentences."""
    return train()


_RANK = {k: i for i, k in enumerate(["email", "address", "id_number", "phone", "person"])}


def find(texts: list[str | None], model: Model, known: Lexicon = Lexicon()) -> list[list[Candidate]]:
    """Accepted spans of each text, in order, without overlaps: mail and postal addresses first, then surer ones, longer ones of equally sure."""
    where, rows = [], []
    for i, text in enumerate(texts):
        for c in candidates(text, known) if text else ():
            where.append((i, c))
            rows.append(features(text, c, known))
    p = model.probability(rows)
    accepted: dict[int, list[tuple[float, Candidate, int]]] = {}
    for n, ((i, c), q) in enumerate(zip(where, p.tolist(), strict=True)):
        if q >= model.thresholds[c.kind]:
            accepted.setdefault(i, []).append((q, c, n))
    out: list[list[Candidate]] = [[] for _ in texts]
    for i, found in accepted.items():
        out[i] = sorted((where[n][1] for n in _apart(found)), key=lambda c: c.start)
    return out


def redact(text: str, spans: list[Candidate]) -> str:
    """The text with each span replaced by its kind in brackets."""
    parts, at = [], 0
    for c in spans:
        parts += [text[at : c.start], f"[{c.kind}]"]
        at = c.end
    return "".join(parts) + text[at:]


def product_lexicon(vocabulary: DataFrame, aliases: DataFrame) -> Lexicon:
    """The lexicon of the names and aliases of a vocabulary (bounded reference tables)."""
    return lexicon(sorted(r["n"] or "" for r in bounded_rows(vocabulary.select(F.col("name").alias("n")).unionByName(aliases.select(F.col("alias").alias("n"))).distinct())))


def find_and_redact(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", known: Lexicon = Lexicon(), with_text: bool = True) -> DataFrame:
    """(id, found array<struct<kind, pii_text, start>>, redacted): personal information of each document, and its text without; no `redacted` where `with_text` is false.

    The model is trained once on the driver from the library's labelled sentences and broadcast. Documents are read once in Arrow batches,
    whole texts, without a shuffle. `known` holds words of product names, which the model weighs. Null stays null, empty
    texts stay empty, repeated rows each give their row. Placeholders are [email], [phone], [id_number], [address] and [person].
    """
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast((default_model(), known))
    id_type = documents.schema[id_col].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("pii_text", pa.string()), ("start", pa.int32())])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, known = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            found: list[list[Candidate]] = []
            for at in range(0, len(texts), 2000):
                found += find(texts[at : at + 2000], model, known)
            lists = [None if t is None else [{"kind": c.kind, "pii_text": t[c.start : c.end], "start": c.start} for c in f] for t, f in zip(texts, found, strict=True)]
            clean = [pa.array([None if t is None else redact(t, f) for t, f in zip(texts, found, strict=True)], pa.string())] if with_text else []
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(lists, pa.list_(item)), *clean], names=[id_col, "found", "redacted"][: 2 + with_text])

    rows = documents.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(scan, f"{id_col} {id_type}, found array<struct<kind string, pii_text string, start int>>" + ", redacted string" * with_text)
