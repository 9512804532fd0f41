"""Labelled lines of shop pages from which the word weights of the boilerplate operator are trained.

Slots stand for what varies: <n> a number, <name> a brand, ingredient or product, <site> the shop's own name.
"""

SURROUNDINGS = [
    # menus, paths, links
    "Home > Brands > Gifts", "Home / Shop / Energy / Herbs / Current item", "Vitamins | Sleep | Brands | Minerals | Help", "Kids | Kitchen | Teas | Beauty | Help",
    "Menu Teas Joints Sport Herbs Search Account Basket (<n>)", "Startseite > Neuheiten > Energie", "Menü Tees Energie Kräuter Suche Warenkorb (<n>)",
    "Inicio > Novedades > Minerales", "Menú Ofertas Minerales Niños Buscar Cesta (<n>)", "Accueil > Plantes > Énergie", "Menu Tisanes Minéraux Enfants Recherche Panier (<n>)",
    "Skip to content", "Zum Inhalt springen", "Saltar al contenido", "Aller au contenu", "Back to results", "Load more", "Search results for products, articles and more",
    "Top searches: Energy, Kids, Bundles, Joints", "Log in  Register  Wish list (<n>)", "Anmelden  Merkzettel (<n>)", "Entrar  Favoritos (<n>)", "Connexion  Favoris (<n>)",
    "Careers  Press  Affiliates  Store finder  Sitemap", "Karriere  Presse  Filialen  Hilfe", "Empleo  Prensa  Tiendas  Ayuda", "Recrutement  Presse  Magasins  Aide",
    "Choose your country and currency", "<name>: all <n> items", "Toda la gama <name>", "Toute la gamme <name>", "Mehr von <name>: <name> <name> <n> ct", "Mehr von <name>: <name> <name> <n> mg", "More from <name>: <name>, <name> <n> mg, <name>",
    # notices
    "This site uses cookies so that the basket works and adverts fit you better. OK, got it", "We and our <n> partners keep small files on your device to measure visits. Accept all - Settings - Reject",
    "Your privacy matters to us: choose which trackers <site> may use. Manage choices", "Only necessary    Statistics    Marketing    Save choice",
    "Storage of identifiers on your device helps us to show <name> offers that fit; you may object at any time.", "Wir verwenden Cookies, um die Seite zu verbessern. Alle annehmen | Nur notwendige",
    "Mit Ihrer Zustimmung messen wir und <n> Partner Ihre Besuche. Einstellungen", "Usamos cookies propias y de <n> socios. Aceptar todo | Rechazar", "Nous utilisons des cookies pour mesurer l'audience. Tout accepter | Refuser",
    "(c) <n> <site>. All rights reserved. Imprint - Terms - Privacy", "(c) <n> <site>. Alle Rechte vorbehalten. Impressum - AGB - Datenschutz",
    "(c) <n> <site>. Todos los derechos reservados. Aviso legal - Condiciones", "(c) <n> <site>. Tous droits réservés. Mentions légales - CGV",
    # the shop, its orders and services
    "Payment: card, invoice, bank transfer, instalments", "Zahlung per Karte, Rechnung oder Lastschrift", "Pago con tarjeta, transferencia o a plazos", "Paiement par carte, virement ou en plusieurs fois",
    "Orders placed before <n> pm leave our warehouse the same working day; returns are accepted for <n> days in the unopened outer box.",
    "Bestellungen bis <n> Uhr verlassen unser Lager am selben Werktag, Rückgabe binnen <n> Tagen.", "Los pedidos salen el mismo día antes de las <n>; devoluciones durante <n> días.",
    "Les colis partent le jour même avant <n> h, retours acceptés pendant <n> jours.", "Trusted shop since <n> - encrypted checkout", "Delivery is free from <n> today only - <n>:<n> left",
    "Heute versandkostenfrei ab <n> Euro Bestellwert", "Envío gratis desde <n> euros", "Livraison offerte dès <n> euros d'achat", "Questions about your parcel? Our service desk answers on weekdays from <n> to <n>.",
    "Fragen zum Paket? Unser Kundendienst hilft werktags bis <n> Uhr.", "¿Preguntas sobre su pedido? Nuestro servicio de atención responde de <n> a <n>.", "Une question sur votre colis ? Notre service client répond jusqu'à <n> h.",
    "Did you find a lower price? Tell us", "Are you a trade buyer? Log in for net prices", "<n> people have this item in their basket right now", "Your basket is empty. Continue shopping",
    "Since <n> the people behind <site> have packed parcels for half a million households, and we still answer every letter ourselves.", "Hello, sign in to see your prices for <name>",
    "Rate this shop  <n> out of <n> based on <n> shop ratings", "Write a review | Report this page", "Add to basket  Add to wish list", "In den Warenkorb", "Añadir a la cesta", "Ajouter au panier",
    # letters, sharing, guides, other products
    "Sign up for our letter and save <n>% on your first order", "Newsletter abonnieren und <n>% sparen", "Suscríbete al boletín y ahorra un <n>%", "Abonnez-vous à la lettre et gagnez <n>% sur la première commande",
    "Follow us for offers, recipes and stories", "Share this page: mail, chat, print", "Seite weiterempfehlen", "Compartir esta página", "Partager cette page", "Guide: how to choose <name> - Read the article",
    "Ratgeber <name> jetzt lesen", "Guía de <name> - leer más", "Guide <name> : lire la suite", "Customers who looked at this also looked at <name> <name> <n> ct", "Bundle and save: add <name> <name> <n> ct",
    "You may also like: <name> <name> <n> ct, <name> <name>", "Recently viewed: <name> <name> <n> ct | <name> <name> <n> mg | <name>", "Zuletzt angesehen: <name> <name> <n> mg | <name> <name>",
    "Das könnte Ihnen auch gefallen: <name> <name> <n> ct, <name> <name>", "Vistos hace poco: <name> <name> <n> ct | <name> <name>", "También te puede gustar: <name> <name> <n> ct, <name> <name>",
    "Vus récemment : <name> <name> <n> ct | <name> <name> <n> mg", "Vous aimerez aussi : <name> <name> <n> ct, <name> <name>", "Notify me when <name> <name> <n> mg is back", "You may also like: <name> <name> <n> mg, <name> <name> <n> g", "Recently viewed: <name> <name> | <name> <name> <n> g | <name> <name> <n> mg", "Das könnte Ihnen auch gefallen: <name> <name>, <name> <name> <n> mg", "También te puede gustar: <name> <name> <n> mg, <name> <name>",
    "Vous aimerez aussi : <name> <name> <n> mg, <name> <name> <n> mg", "Vus récemment : <name> <name> <n> g | <name> <name> <n> mg", "Bundle and save: add <name> <name> <n> g", "Customers who looked at this also looked at <name> <name> <n> mg", "Vistos hace poco: <name> <name> | <name> <name> <n> mg", "Track your order", "Gift cards and vouchers", "Download our app", "Contact us  About us  FAQ",
]

MAIN_TEXT = [
    # the product and its make-up
    "<name> <name> brings <n> mg of <name> in every serving of this bottle.", "<name> <name> liefert <n> mg je Portion.", "<name> <name> aporta <n> mg por toma.", "<name> <name> apporte <n> mg par portion.",
    "Each bottle holds <n> capsules, enough for about <n> weeks.", "Eine Packung enthält <n> Tabletten und reicht etwa <n> Wochen.", "Un envase trae <n> cápsulas, para unas <n> semanas.", "Un flacon contient <n> gélules, soit environ <n> semaines.",
    "Home-baked taste, fairly priced.", "Home-baked taste, easy to swallow.", "A home-grown classic since <n>, now with finer silica.", "The formula is gentle on the stomach and made without soy or milk.", "No artificial colours", "Vegan.",
    "Tastes like a warm cookie from the oven, without added sugar.", "Schmeckt wie ein frischer Keks vom Blech.", "Vegano, con sabor a galleta recién hecha.", "Végan, goût agréable de biscuit.", "Vegan und gut verträglich.",
    "Ohne Milch, ohne Soja, ohne künstliche Farbstoffe.", "Sin leche, sin soja, sin colorantes.", "Sans lait, sans soja, sans colorant.", "Free from celery, milk and soy", "Free from crustaceans, sesame and egg", "Free from fish, nuts and fish", "Free from nuts, crustaceans and sesame", "The capsules are coated with glycerin so that they stay easy to swallow.",
    "We accept no soy on the line that fills this jar.", "We source the raw <name> from our own greenhouse and test every batch for shelf life.", "We measure moisture uptake in each batch.", "Orange.", "Lemon.", "Mixed Berry.", "frutos del bosque.", "fruits des bois.", "Minze.",
    "Ingredients: <name>, <name>, citric acid, rice flour, silica.", "Zutaten: <name>, <name>, glycerin, pectin.", "Ingredientes: <name>, <name>, beeswax, xylitol.", "Ingrédients : <name>, <name>, sunflower lecithin.", "<name>, <name>, beeswax, sunflower lecithin, natural colour.", "Vitamin K2, Vitamin B12, <name>, citric acid, tapioca starch, carnauba wax.", "Ingrédients : Vitamine B6, <name>, Vitamine D3, maltodextrin, microcrystalline cellulose.", "<name>, vegetable stearate, acacia gum, pullulan.",
    "Contains milk. May contain traces of milk.", "Kann Spuren von Milch und Soja enthalten.", "Puede contener trazas de leche y soja.", "Peut contenir des traces de lait et de soja.",
    # what it is said to do, how to use it
    "<name> contributes to normal skin as part of a varied diet.", "<name> trägt zu einer normalen Funktion des Körpers bei.", "<name> contribuye al funcionamiento normal del cuerpo.", "<name> contribue au bon fonctionnement de l'organisme.",
    "Für Menschen, die sich etwas müde fühlen möchten.", "Good on the breakfast menu of anybody who thinks about eyes.", "People who care about their nerves often add <name> after breakfast.", "Para personas que quieren sentirse más tranquilas.", "Pour ceux qui veulent se sentir moins fatigués.",
    "Take <n> capsules every other day, or as your practitioner advises.", "Täglich <n> Kapseln nach dem Frühstück einnehmen.", "Tomar <n> cápsulas al día después de entrenar.", "Prendre <n> gélules par jour avec un grand verre d'eau.",
    "Share one box between two people for <n> days.", "Search for <name> in our field notes and you will find two family growers.", "Search for <name> in our field notes and you will find a small valley.", "Search for <name> in our field notes and you will find our own greenhouse.", "Read the leaflet of <name> <name> before the first serving.", "Packungsbeilage vor der ersten Einnahme lesen.", "Leer el prospecto antes de la primera toma.", "Lire la notice avant la première prise.",
    # storage, warnings, checks
    "Store the box dry and below <n> degrees, away from sunlight.", "Contact with moisture should be avoided once the bottle is open.", "Trocken und lichtgeschützt lagern.", "Conservar en lugar seco y sin luz directa.", "À conserver au sec, à l'abri de la lumière.",
    "Keep out of reach of children; do not exceed the stated serving.", "Not suitable during pregnancy unless agreed with a doctor.", "Für Kinder unzugänglich aufbewahren, angegebene Menge nicht überschreiten.", "No superar la dosis indicada; mantener fuera del alcance de los niños.", "Ne pas dépasser la dose conseillée ; tenir hors de portée des enfants.",
    "Reviewed by our quality team in October for bioavailability.", "In our own tasting <n> of <n> people called it simple to dose.", "Our shelf life limits are <n> percent tighter than usual.", "Sign of a good batch: the lozenges are well packed.", "Return the jar to a dry shelf after use.", "Order of steps: open, take, close.",
    "Der Rohstoff stammt aus kontrolliertem Anbau und wird auf Reinheit geprüft.", "La materia prima procede de cultivos controlados y cada lote se analiza.", "La matière première vient de cultures contrôlées et chaque lot est analysé.",
    # values that say nothing belong to no page surroundings
    "?", "n/a", "N/A", "N.A.", "k. A.", "-", "--", "none", "null",
    # several sentences on a line
    "Lire la notice avant la première prise. <n> pastilles", "Each bottle holds <n> coated tablets, enough for about <n> weeks. <n> coated tablets", "Un envase trae <n> gomitas, para unas <n> semanas. <n> gomitas", "Vegan. No artificial colours", "The formula is easy to swallow and made without fish or fish. <n> melt lozenges", "People who care about their mood often add <name> around noon. <n> liquid softgels", "The vegetable capsules are coated with carnauba wax so that they stay quick to dissolve. Sign of a good batch: the soft gels are fairly priced.", "<n> Kapseln Packungsbeilage vor der ersten Einnahme lesen.",
    # facts panels
    "Supplement Facts", "Nutrition information", "Nährwertangaben", "Información nutricional", "Informations nutritionnelles", "Serving Size: <n> capsules", "Serving Size <n> (<n> g)", "Serving Size <n> pack (<n> oz)", "Servings Per Container <n>",
    "Portionsgröße: <n> Kapseln", "Portionsgröße <n> (<n> g)", "Portionen pro Packung <n>", "Tamaño de la toma: <n> cápsulas", "Tomas por envase <n>", "Portion: <n> gélules", "Portions par flacon <n>", "Energy <n> kcal", "Energy: <n> kJ", "Brennwert <n> kcal", "Energía: <n> kJ", "Énergie <n> kcal",
    "** Daily value not established", "** Nährstoffbezugswert", "** Valores de referencia", "** Valeurs de référence", "<name> <n> mg", "<name> (as <name>) <n> mg <n>% DV", "<name>: <n> mcg | <n>% NRV**", "<name> (als <name>) ........ <n> IE <n>%", "Sägepalme (als Serenoa Repens) <n> mg", "<name> <n> billion CFU", "<name> (como <name>) <n> g", "<name> (sous forme de <name>) <n> µg",
    "Racine de Valériane <n>MG", "Aceite de Onagra <n>mg", "Extracto de Té Verde <n> mg", "Vitamina A <n> UI", "Huile MCT <n>mg", "Hyaluronic Acid <n>mg", "<name> <n> MG", "<name>: <n> mg", "<name> <n> ug", "<n> capsules", "<n> Kapseln", "<n> cápsulas", "<n> gélules", "Supplement Facts • Serving Size: <n> capsules • Servings Per Container <n> • <name>: <n> mg <n>% • <name> <n> g",
]
