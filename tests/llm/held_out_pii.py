"""Marked sentences of which neither wording nor names, streets or towns occur in the labelled sentences of the library: [[kind:text]] marks an item."""

import re

TEXTS = [
    "The courier handed everything to [[person:John Green]] and left a card.", "[[person:Will Smith]] phoned about his refund yesterday.", "We heard from [[person:Betty White]] that the seal was fine.", "[[person:April Jones]] and [[person:June Carter]] share a subscription.", "Mr [[person:Peter Black]] would prefer a smaller bottle.",
    "Our trainer is [[person:Rose Miller]], she recommends it.", "A refund was issued to [[person:Wei Zhang]] last week.", "Yesterday [[person:Ludwig van der Berg]] visited the warehouse.", "[[person:Maria de la Cruz]] left a five star rating.", "Many thanks, [[person:Dimitra Papadopoulou]]", "[[person:Sergei Volkov]] is our new pharmacist.",
    "I gave the second jar to [[person:Harriet Osei]].", "Kind wishes\n[[person:Tobias Lindqvist]]", "[[person:Farah Siddiqui]] replied within an hour.", "The complaint of [[person:Angus McDonald]] is closed.", "Mein Nachbar [[person:Uwe Brandt]] schwört darauf.", "Herzlich, [[person:Heike Zimmermann]]", "La doctora [[person:Rocío Navarro]] lo recomienda.", "Atentamente, [[person:Gonzalo Herrera]]", "Bien à vous, [[person:Solène Marchand]]",
    "Monsieur [[person:Baptiste Renaud]] souhaite un échange.", "Distinti saluti, [[person:Alessandra Conti]]", "Groetjes, [[person:Femke Visser]]", "[[person:Михаил Лебедев]] написал отзыв.", "[[person:O'Neill, Siobhan]] ordered twice.", "[[person:K. Yamamoto]] asked for the leaflet.",
    "The office is at [[address:1600 Pennsylvania Avenue NW, Washington, DC 20500]].", "Send samples to [[address:17 Primrose Crescent, Harrogate HG2 8QT]] please.", "Pick it up at [[address:PO Box 771, Fresno, CA 93710]].", "She lives at [[address:88 West 5th Avenue, Denver, CO 80204]].", "Ich wohne [[address:Sonnenallee 14, 12047 Neukirch]] im Hinterhaus.", "Rechnung an [[address:Postfach 2204, 80331 Freising]].", "Vive en [[address:Calle de Serrano 45, 28001 Getafe]].", "Nous sommes au [[address:9 boulevard Carnot, 06400 Cannes]].",
    "Spedire a [[address:Via Garibaldi 21, 20121 Pavia]].", "Bezorgen op [[address:Dorpsstraat 3, 1181 AB Amstelveen]].", "Old address: [[address:204 Maple Lane, Dayton, 45402]]",
    "Her cell is [[phone:+1 646-555-0199]] most days.", "You may dial [[phone:(415) 555-0123]] before noon.", "Mobil: [[phone:+49 171 2345678]]", "Mi móvil es [[phone:612 34 56 78]].", "Mon portable : [[phone:06 12 34 56 78]]", "Hotline [[phone:0800 123 4567]] is free.", "WhatsApp me at [[phone:+44 7911 123456]]!",
    "Write to [[email:jane_doe.99@mail.example.org]] for details.", "Kontakt: [[email:info.team@firma.example]]", "my mail is [[email:peter (at) posteo (dot) test]] now", "Contact [[email:x-y+z@sub.domain.test]], please.",
    "Passport no. [[id_number:C01X00T47]] was copied.", "SSN on the form: [[id_number:219-09-9999]].", "Mein Ausweis: [[id_number:L22990047]]", "DNI [[id_number:12345678Z]] en el recibo", "National Insurance: [[id_number:AB 12 34 56 C]]", "IBAN [[id_number:DE89 3704 0044 0532 0130 00]] for the refund",
    "Order 12-3456789 shipped on 3 May 2021.", "Lot AB123456 expires in 2026.", "Green Tea and Black Pepper go well together.", "Cold Pressed Virgin Coconut Oil", "Item 4006381333931 is sold out.", "Rated 4.5 by 1,204 buyers.", "The Mediterranean Diet Study began in 1999.", "Serving size 2 scoops (30 g), 25 servings.", "Ask about Saint John's Wort.", "Buy Two Get One Free on Friday.", "Batch 2023-11-05 passed the Heavy Metals Test.", "New Year Sale ends Sunday.", "Whole Foods carries it.", "Good Morning America mentioned it.",
]


def parsed():
    """(text, [(kind, item), ...]) of each sentence."""
    return [(re.sub(r"\[\[\w+:(.*?)\]\]", r"\1", t, flags=re.S), re.findall(r"\[\[(\w+):(.*?)\]\]", t, flags=re.S)) for t in TEXTS]
