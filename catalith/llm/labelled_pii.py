"""Labelled sentences from which the redaction model is trained: {kind} marks a place that holds an item of that kind, all else holds none."""

from __future__ import annotations

import random

SENTENCES = [
    # names
    "My name is {person}. The bottle smells of hay.", "Ask for {person} at the desk.", "Thanks to {person} for the quick help.", "It was {person} who opened the parcel", "Regards,\n{person}", "Kind regards,\n{person} Content by HPLC: 12 mg",
    "Reviewed by {person}", "Reviewed by {person} Update after 2 weeks: still calm.", "Mein Name ist {person}.", "La señora {person} me atendió.", "El señor {person} me ayudó.", "Me llamo {person}. Tomo esto desde hace 2 semanas.", "Lo abrió {person} en casa.",
    "Das Paket nahm {person} an.", "Mit freundlichen Grüßen\n{person} Der Preis ist in Ordnung", "Cordialement,\n{person}", "Un saludo,\n{person}", "Saludos,\n{person} El paquete llegó bien.", "Signé : {person}", "Viele Grüße, {person} Der Preis ist gut.", "Je m'appelle {person}.",
    "Dr. {person} from the clinic told me so.", "Signed: {person}\n- Storage matters.", "I, {person}, sent it back on Thursday.", "cc {person} I bought it in May.", "Firmado: {person} El paquete llegó en 9 días.", "C'est {person} qui a ouvert le colis.", "{person} wrote: Update after 7 weeks",
    "{person} wrote:", "Even {person} noticed that the seal was broken.", "Frau {person} hat mich beraten.", "Herr {person} rief zurück.", "Madame {person} m'a conseillée.", "Monsieur {person} a répondu.", "Mrs {person} called twice.", "Mr {person} from accounts paid.", "{person} from the clinic told me so.",
    "I spoke to {person} last week.", "Please contact {person} about it.", "Attn: {person}", "Patient: {person}", "Dear {person},", "Hola {person}, gracias.", "Unterschrift: {person}", "Gesendet von {person}", "Yours, {person}",
    "The parcel was signed for by {person} at noon.", "{person} and {person} both tried it.", "According to {person}, the lid was loose.", "Our neighbour {person} took the box in.", "Customer: {person}", "Account holder {person}", "Name: {person}", "Contact person: {person}", "Invoice to {person}", "Recipient: {person}\n", "cc: {person}, sales", "In March {person} sent a photo.",
    "Ansprechpartner ist {person}.", "Laut {person} war der Deckel lose.", "Bestellt von {person} im Mai.", "Kundin: {person}", "A nombre de {person}", "Según {person}, el frasco estaba abierto.", "Au nom de {person}", "Selon {person}, le colis est perdu.", "Il signor {person} ha chiamato.", "Met vriendelijke groet, {person}", "Med vänlig hälsning, {person}", "С уважением, {person}", "Με εκτίμηση, {person}",
    "Miss {person} asked for a refund.", "Prof. {person} wrote the leaflet.", "My sister {person} uses it too.", "My husband {person} likes it.", "Mi hermana {person} también lo toma.", "Mon mari {person} en prend.", "Meine Frau {person} nimmt es auch.", "Will {person} be there on Monday?", "Was {person} told about it?", "I met {person} in June.", "{person} (customer since 2015)", "{person}, 43, takes it daily.", "{person} said so.", "{person} rang twice.", "{person}\nCustomer service",
    "Best regards,\n{single}", "Thanks, {single}", "Dear {single},", "Hi {single}, the parcel is here.", "Hola {single}, gracias.", "Liebe {single},", "Cheers,\n{single}", "Mrs {single} called twice.", "Herr {single} rief zurück.", "Dr. {single} told me so.", "Madame {single} a répondu.", "My name is {single}.",
    "Will Power is a brand of gum.", "May Day offers end on Monday.", "In April Green Tea was sold out.", "White Willow and Black Cohosh were mixed.", "Long Pepper tastes sharp.", "Winter Cherry is a plant.", "Rose Hip and Green Lipped Mussel were tested.", "Hello Sunshine is a slogan.", "Dear Customer, thank you.", "Dear Team, the box is open.", "Hi Folks, is it vegan?", "Thanks, Support Desk", "Regards, Customer Care", "Cheers,\nThe Shop", "Prime Lane Court Pharmacy sells it.", "Central Street Market opens early.", "Union Square Health Store has it.", "{product} and {product} in June.", "{brand} {product} from the Black Forest.", "The Alpine Spring Water is cold.", "Made in New Zealand and South Korea.", "Shipped via Deutsche Post from Bad Homburg.", "Read more in Nature Medicine or Food Chemistry.", "The Journal Of Clinical Nutrition reported it.", "University Hospital Zurich ran the trial.", "Royal Mail lost it.", "Monday Morning Mix is new.", "Extra Strength {product} is sold out.", "Clean Label Project award.", "Best Before End March.", "Use By Date: May", "Black Friday and Cyber Monday deals.",
    # mail addresses
    "Please answer to {email}.", "You can reach me at {email}, thanks", "(mail: {email})", "Sent from {email}", "<{email}> wrote on Friday: the bottle is late.", "Mi correo: {email}", "Mon adresse est {email}", "Erreichbar unter {email} oder im Laden.", "Antwort bitte an {email}",
    # phones
    "Call me on {phone} after six.", "My number is {phone}.", "ph: {phone}; evenings only", "tel {phone}", "Tel.: {phone} Würde ich wieder kaufen?", "Text {phone} when the parcel ships", "Telefonisch bin ich unter {phone} zu erreichen.", "Llámenme al {phone} por la tarde.", "Appelez-moi au {phone} le soir.",
    "Tel. {phone} Mi hermana no nota nada", "Tél. {phone}", "mobile {phone}", "tel {phone} Is it free of fish?", "Tel.: {phone} 30 Kaps. am Tag", "Tel.: {phone} 240 Fruchtgummis", "ph: {phone}, thanks", "tel {phone}", "Ring {phone} please.", "fax {phone}", "WhatsApp {phone}", "{phone}", "\n{phone}\n", "Phone: {phone}",
    # identity numbers
    "My passport number is {passport}.", "passport {passport} I would like a refund", "They asked for my SSN ({ssn}) which felt odd.", "For the customs form: social security number {ssn}.", "ID number on file: {ssn}", "ID number on file: {ni}", "ID number on file: {passport}", "ID number on file: {ni} Vegan. Read the label.", "My national insurance no. is {ni} Thanks for that.", "They wanted my ID ({passport}) again.", "My national insurance no. is {ni}.", "NI number {ni}", "Mi DNI es {dni}.", "NIF {dni} para la factura", "NIE {nie}",
    "Numéro de sécurité sociale : {nir}.", "NIR {nir} pour le dossier", "Mein Personalausweis: {passport}", "Ausweisnummer {passport} liegt bei.", "Steuer-ID {taxid}", "Meine Steuernummer lautet {taxid}.", "pasaporte {passport}", "passeport n° {passport}", "IBAN {iban}", "driver's licence {passport}",
    # addresses
    "Ship to: {address}", "Please send it to {address}.", "It should have gone to {address}; nobody rang.", "Meine Anschrift: {address}", "Bitte liefern an {address}.", "Envíenlo a {address}.", "Mi dirección: {address}", "Adresse : {address}", "Merci de livrer au {address}.", "I live at {address}.", "Address: {address}\n",
    "Deliver to {address} by Friday.", "The flat at {address} is mine.", "We moved to {address} in June.", "Return address: {address}", "Lieferadresse: {address}", "Wohnhaft in {address}", "Domicilio: {address}", "J'habite au {address}.", "Indirizzo: {address}", "Adres: {address}", "Billing address: {address}.", "My office is at {address}, ring twice.", "{address}\n", "{person}\n{address}\n", "It stood before {address} all day.",
    # what looks like it
    "Order 987-65-43 was split.", "Order {order} was split.", "GTIN 0400000505 printed on the side.", "GTIN {gtin} printed on the side.", "Item no. 555-01 is out of stock.", "Item no. {order} is out of stock.", "Hello, order {order} from May is still not here.", "Lot {order} best before March 2019", "Bitte prüfen Sie die Charge {order}, der Deckel war locker.",
    "El lote {order} olía un poco a hierba seca.", "Le lot {order} sentait un peu l'herbe.", "Sample {order}: Taurine, Caps, received in March 2021.", "sku;qty;price\n{order};79;79.40\n{order};84;18.84\n{order};12;12.99", "The study ran from 2019-04-12 to 2020-01-30.", "The study ran from 2021-03-02 to 2022-11-15.", "Follow @leafy05 for recipes.", "Use code SAVE05 at checkout.",
    "The sample labelled K74R63 shows 32 percent recovery while the control shows 821 counts.", "can't 'tis 123456789 1,234.5e-6 x=y*z", "Retained sample kept for 10 months.", "Tracking {gtin} shows no movement.", "Invoice {gtin} is paid.", "Article {order} was replaced.", "Batch {gtin} passed.", "Batch {no-ni} passed.", "Lot {no-passport} was recalled.", "Part {no-ni} fits.", "Serial {no-passport} is engraved.", "Model {no-dni} is discontinued.", "Order {no-ssn} was split.", "Item {no-phone} is a part number.", "version 2.10.3 of 12 May 2020", "ISBN {gtin}",
    "Main Street Pharmacy Blend is only a product name.", "Panax Ginseng and Ginkgo Biloba were tested side by side.", "The {product} {product} lost its seal.", "{brand} {product} aporta 5 g por toma.", "{brand} {product} apporte 750 mg par portion.", "{brand} {product} brings 40 mg in every serving.", "Tomo {brand} Extracto de {product} desde hace 8 semanas.", "{brand} {product}, 60 ct", "{product} {brand} from the shop", "Die Packung {brand} {product} war offen.", "I bought the {brand} {product} in March.", "{brand} {product} liefert 250 mg je Portion.", "Compared with the other {product} I tried it is good.", "Can I combine {product} with {product}?",
    "Each jar holds 30 Chewable Gummies, enough for 2 weeks.", "Take 4 Melt Lozenges after training.", "Suggested use: 3 Vegetable Capsules around noon.", "SUPPLEMENT FACTS Serving size 8 Vegetable Capsules Manufactured for {brand}", "Manufactured for {brand} in a facility that also handles fish.", "How should I take {brand} {product}?", "The Coated Tablets are coated with pectin.",
    "{product} contributes to normal nerves.", "We source the raw {product} from the coast.", "Content by ICP-MS: 1,200 mg", "Green Valley Naturals is a brand.", "A Monday in March was cold.", "Many labels mix up the amount of {product} itself.", "Where does the {product} come from? From the coast.", "Does heat harm the Gummy Bites?", "Read the leaflet of {brand} {product} first.",
    "Ich nehme {brand} {product} seit 2 Wochen.", "Tomo {brand} {product} desde hace 4 semanas.", "Je prends {brand} {product} depuis 9 semaines.", "Saw Palmetto and Milk Thistle sound clever.", "Reviewed by our quality team in October for bioavailability.", "Search for {product} in our field notes.", "Good on the breakfast menu of anybody.", "Home Baked Taste, Fairly Priced", "Vegan, Tasty, Cheap.", "Contains Milk, Soy, Egg.", "Bought in Berlin, Germany.", "Sold in Paris, Madrid, Rome.", "Read, Sealed, Delivered.", "Zutaten: Glycerin, Pektin, Zitronen.",
    "Thanks to Vitamin C I felt better.", "Ask for Krill Oil at the pharmacy.", "It was Fish Oil that helped.", "Even Green Tea Extract did nothing.", "Regards, Your Vitamin Team", "Central Park Wellness opens at 10.", "Signed Edition Black Label", "Dr. Green Labs makes it.", "North Sea Algae Oil was tested.", "New York Times Square", "The Grand Hotel Blue Lagoon",
]

# Given names common in the languages of the corpus.
GIVEN_NAMES = [
    "Adam", "Alice", "Amira", "Ana", "Andrea", "Andrés", "Anna", "Björn", "Carlos", "Charlotte", "Chloé", "Christian", "Claire", "Daniel", "David", "Elena", "Emil", "Emma", "Felix", "Fiona", "Grace", "Greta", "Hannah", "Hans", "Hugo", "Ines", "Ivan", "James", "Jan",
    "Jean", "Johanna", "John", "Jonas", "José", "Juan", "Julia", "Karin", "Kenji", "Klaus", "Laura", "Lena", "Leon", "Luca", "Lucas", "Lucía", "Luis", "Marco", "Maria", "María", "Marie", "Martin", "Mary", "Max", "Mei", "Michael", "Nina", "Nora", "Olga", "Olivia", "Oskar",
    "Pablo", "Paul", "Peter", "Pierre", "Priya", "Ravi", "René", "Robert", "Sara", "Sarah", "Sean", "Sofia", "Sophie", "Stefan", "Susan", "Thomas", "Tomas", "Victor", "William", "Yusuf", "Zoe", "Zoë",
    "George", "Henry", "Jack", "Emily", "Elizabeth", "Jennifer", "Linda", "Barbara", "Patricia", "Margaret", "Richard", "Charles", "Joseph", "Edward", "Kevin", "Karen", "Lisa", "Helen", "Ruth", "Simon", "Andrew", "Mark", "Anthony", "Kate", "Rachel", "Rebecca", "Samuel", "Benjamin", "Oliver", "Harry", "Tom", "Rose", "Betty", "Will",
    "Wolfgang", "Jürgen", "Uwe", "Heike", "Sabine", "Petra", "Monika", "Ursula", "Andreas", "Matthias", "Tobias", "Sebastian", "Florian", "Katharina", "Ludwig", "Antonio", "Manuel", "Javier", "Miguel", "Alejandro", "Pilar", "Isabel", "Teresa", "Rosa", "Diego", "Sergio", "Fernando",
    "Nicolas", "Julien", "Philippe", "Isabelle", "Nathalie", "Camille", "Antoine", "François", "Giuseppe", "Giovanni", "Francesca", "Paolo", "Chiara", "Ahmed", "Mohammed", "Fatima", "Ali", "Omar", "Aisha", "Wei", "Li", "Yuki", "Hiroshi", "Anil", "Sergei", "Dmitri", "Natalia", "Piotr", "Agnieszka", "Jakub", "Lars", "Erik", "Ingrid", "Sven", "Pieter",
    "Анна", "Иван", "Михаил", "Елена", "Сергей", "Мария",
]

_SUR = (["Mar", "Hol", "Ber", "Ost", "Lin", "Wal", "Kar", "Fen", "Dor", "Sand", "Brun", "Hart"], ["berg", "mann", "ley", "sson", "etti", "quist", "ford", "ovic", "brook", "ault", "wen", "ada", "gaard", "reyes", "stow", "hurst"])
# Given names the trees get no list of, surnames, some of them words of other use, and names in other scripts.
OTHER_GIVEN = ["Aiko", "April", "June", "Arjun", "Beatriz", "Bjarne", "Carmen", "Ciarán", "Dagny", "Dimitris", "Eszter", "Fatima", "Gareth", "Giulia", "Hiroshi", "Ilse", "Joaquín", "Jorge", "Jun", "Katarzyna", "Kofi", "Liam", "Lars", "Lucía", "Mark", "Matteo", "Mehmet", "Milan", "Ngozi", "Noor", "Oleg", "Owen", "Pilar", "Quentin", "Rose", "Sanjay", "Sigrid", "Tariq", "Ute", "Valérie", "Will", "Xiang", "Yara", "Zoltan", "April", "June", "Betty", "Frank", "Heather", "Ivy"]
SURNAMES = ["Smith", "Jones", "Brown", "Taylor", "Wilson", "Green", "White", "Black", "Carter", "Baker", "Hill", "Lane", "Long", "Winter", "Park", "King", "Young", "O'Connor", "McKenzie", "MacLeod", "Müller", "Schmidt", "Weber", "Fischer", "Vogel", "Dubois", "Moreau", "Lefèvre", "García", "Fernández", "Ruiz", "Rossi", "Bianchi", "Silva", "Kowalski", "Novák", "Horváth", "Popescu", "Johansson", "Nielsen", "Virtanen", "Nguyen", "Kim", "Zhao", "Tanaka", "Patel", "Singh", "Hassan", "Okafor", "Yılmaz", "Georgiou"]
_PARTICLED = ["van den Broek", "van Dijk", "von Arnim", "de la Torre", "de Souza", "del Río", "di Marco", "bin Rashid", "ten Hove"]
_SCRIPTS = ["Иван Соколов", "Анна Кузнецова", "Пётр Орлов", "Γιώργος Νικολάου", "Ελένη Δημητρίου", "Олена Шевченко"]
_CITY = (["Hollen", "Brind", "Moss", "Valmor", "Sierra", "Weiden", "Puert", "Font", "Kestrel", "Dun"], ["au", "low", "gate", "ne", "blanda", "bach", "alba", "claire", "ham", "marsh"])
_BRAND = (["Verg", "Tam", "Lor", "Mex", "Xan", "Jas", "Ulm"], ["uzon", "cetis", "diyra", "sigil", "nahal", "pifin", "vox"])
PRODUCT_NAMES = ["Krill Oil", "Vitamin C", "Ginkgo", "Milk Thistle", "Saw Palmetto", "Grape Seed Extract", "Lion's Mane", "Green Tea Extract", "Zinc", "Fish Oil", "Collagen Peptides", "Alpha Lipoic Acid", "Saccharomyces Boulardii", "Rose Hip", "Black Cohosh", "White Willow", "Winter Cherry", "Long Pepper", "Green Lipped Mussel", "Inulina", "Taurin", "Té Rojo", "Melatonina", "Brennnessel", "Ortie Blanche", "Zink", "Hierro", "Yodo", "Curcuma", "Aceite de Lino", "Huile de Lin", "Rote Bete", "Ginseng Rojo", "Lactasa", "Sélénium", "Kreatin", "Uña de Gato", "Maca", "Reishi"]
_ROAD = ["Mill", "Larch", "Harbour", "Quarry", "Foundry", "Chapel", "Station", "Church"]


def _digits(r: random.Random, n: int) -> str:
    return "".join(str(r.randrange(10)) for _ in range(n))


def _shape(r: random.Random, shape: str) -> str:
    return "".join(str(r.randrange(10)) if c == "#" else r.choice("ABCDEFGHJKLMNPRSTUVWXYZ") if c == "?" else c for c in shape)


def _join(r: random.Random, parts: tuple[list[str], list[str]]) -> str:
    return r.choice(parts[0]) + r.choice(parts[1])


def fill(r: random.Random, slot: str) -> tuple[str, str | None]:
    """(text, kind) for a slot; kind is None for slots that hold no personal information (those named no-... only look like it)."""
    if slot.startswith("no-"):
        return fill(r, slot[3:])[0], None
    if slot == "person":
        if r.random() < 0.04:
            return r.choice(_SCRIPTS), "person"
        first, last = r.choice(GIVEN_NAMES if r.random() < 0.6 else OTHER_GIVEN), _join(r, _SUR) if r.random() < 0.5 else r.choice(SURNAMES)
        if r.random() < 0.15:
            first += "-" + r.choice(GIVEN_NAMES)
        if r.random() < 0.12:
            last += "-" + _join(r, _SUR)
        elif r.random() < 0.08:
            last = r.choice(_PARTICLED)
        elif r.random() < 0.08:
            first = f"{first} {r.choice(OTHER_GIVEN if r.random() < 0.2 else GIVEN_NAMES)}"
        return r.choice([f"{first} {last}"] * 6 + [f"{first} {r.choice('ABCDEFGHJKLMR')}. {last}", f"{first[0]}. {last}", f"{last}, {first}"]), "person"
    if slot == "single":
        return r.choice([*GIVEN_NAMES, *OTHER_GIVEN, *SURNAMES]), "person"
    if slot == "email":
        user = r.choice([f"{r.choice(GIVEN_NAMES).lower()}.{_join(r, _SUR).lower()}", f"{_join(r, _SUR).lower()}{_digits(r, 2)}", f"{r.choice(GIVEN_NAMES).lower()}_{_join(r, _SUR).lower()}+shop"])
        at, dot = r.choice([("@", ".")] * 4 + [(" [at] ", " [dot] "), (" (at) ", " (dot) "), (" @ ", "."), (" at ", " dot ")])
        return user + at + dot.join(r.choice([["quickmail", "test"], ["postbox", "example", "net"], ["letters", "example"]])), "email"
    if slot == "phone":
        shapes = ["(###) ###-####", "###-###-####", "###.###.####", "### ### ####", "1-###-###-####", "+1 ###-###-####", "+1##########", "+1##########", "+49##########", "+33#########", "+34#########", "+44 20 #### ####", "+44 (0)20 #### ####", "07### ######", "+447#########", "+447### ######", "0##/########", "+49 30 ##### ###", "0049 30 #####-###", "+34 9## ## ## ##", "+349## ######", "9## ### ###", "+33 1 ## ## ## ##", "01 ## ## ## ##", "01.##.##.##.##", "+331## ######"]
        return _shape(r, r.choice(shapes)), "phone"
    if slot in ("passport", "ssn", "ni", "dni", "nie", "nir", "taxid", "iban"):
        shapes = {"passport": ["?#######", "?########", "??#######"], "ssn": ["###-##-####", "### ## ####"], "ni": ["??######?", "?? ## ## ## ?"], "dni": ["########?", "########-?"], "nie": ["X#######?", "Y-#######-?"], "nir": ["1 ## ## ## ### ### ##", "2 ## ## ## ### ### ##"], "taxid": ["## ### ### ###", "###########", "##/###/#####"], "iban": ["DE## #### #### #### #### ##", "ES## #### #### #### #### ####"]}
        return _shape(r, r.choice(shapes[slot])), "id_number"
    if slot == "address":
        n, city, code = f"{r.randrange(1, 250)}{r.choice(['', '', 'b', 'A'])}", _join(r, _CITY) if r.random() < 0.7 else r.choice(["London", "Austin", "Boston", "Leeds", "Berlin", "Köln", "Madrid", "Lyon", "Sevilla", "New Haven", "San Diego", "Bad Homburg"]), _digits(r, 5)
        road, gap = r.choice([*_ROAD, "Oak", "King", "Park", "5th", "42nd", "Queen Anne", "Old Mill"]), r.choice([", ", ", ", "\n"])
        unit = r.choice(["", "", f", Apt {r.randrange(1, 20)}", f", Flat {r.randrange(1, 20)}"])
        kind = r.choice(["Street", "Street", "Lane", "Lane", "Road", "Road", "Ave.", "Ave.", "Crescent", "Parkway", "Drive", "Boulevard", "Close", "Terrace", "Avenue NW"])
        uk, state = _shape(r, r.choice(["??# #??", "?## #??", "??## #??"])), r.choice(["DC", "TX", "CA", "NSW"])
        english = [f"{n} {road} {kind}{unit}{gap}{city}{end}" for end in ("", f", {code}", f" {code}", f", {state} {code}", f" {uk}", f", {uk}")]
        forms = [
            r.choice(english), r.choice(english), f"{r.choice(['Mühlenstraße', 'Kirchweg', 'Lindenallee', 'Gartenstr.', 'Goetheplatz', 'Am Markt', 'Alte Gasse'])} {n}{gap}{code} {city}", f"{r.choice(['Calle del Molino', 'Avenida de la Encina', 'Calle Mayor', 'Paseo del Prado', 'Plaza Nueva'])}{r.choice(['', ','])} {n}{gap}{code} {city}",
            f"{n} {r.choice(['rue des Alouettes', 'avenue de la Gare', 'rue du Moulin', 'boulevard Voltaire', 'chemin des Vignes'])}{gap}{code} {city}", f"{r.choice(['Via Roma', 'Via dei Mille', 'Corso Italia', 'Piazza Garibaldi'])}{r.choice(['', ','])} {n}{gap}{code} {city}",
            f"{r.choice(['Kerkstraat', 'Lindelaan', 'Marktplein', 'Keizersgracht'])} {n}{gap}{_shape(r, '#### ??')} {city}", f"{r.choice(['PO Box', 'P.O. Box'])} {_digits(r, 4)}{gap}{city}, {state} {code}", f"Postfach {_digits(r, 4)}{gap}{code} {city}",
        ]
        return r.choice(forms), "address"
    if slot == "order":
        return _shape(r, r.choice(["##-####", "###-##-##", "###-##", "######"])), None
    if slot == "gtin":
        return _shape(r, r.choice(["##########", "#############", "04########"])), None
    return (_join(r, _BRAND) if slot == "brand" else r.choice(PRODUCT_NAMES)), None


def examples(sentences: list[str] | None = None, copies: int = 16, seed: int = 7) -> list[tuple[str, list[tuple[int, int, str]]]]:
    """(text, marked spans) made from `sentences` (all where None), each filled `copies` times and set between two others of them."""
    r = random.Random(seed)
    sentences = sentences or SENTENCES

    def one(sentence: str, at: int) -> tuple[str, list[tuple[int, int, str]]]:
        text, spans, rest = "", [], sentence
        while "{" in rest:
            head, _, rest = rest.partition("{")
            slot, _, rest = rest.partition("}")
            text += head
            value, kind = fill(r, slot)
            if kind:
                spans.append((at + len(text), at + len(text) + len(value), kind))
            text += value
        return text + rest, spans

    out = []
    for sentence in sentences:
        for _ in range(copies):
            text, spans = "", []
            for s in (r.choice(sentences), sentence, r.choice(sentences)):
                part, found = one(s, len(text))
                spans += found
                text += part + r.choice([" ", " ", "\n", "\n\n", "\n- "])
            out.append((text, spans))
    return out
