"""Polish word lists and label names that the rules compare with.

Fixed values: they decide results and are stated as they are.
"""

NO_EVENT = "BRAK_ZDARZENIA"

FIELDS = ("who", "what", "trigger", "where", "when")

PERSON_ENTITIES = ("persName", "PER", "PERSON")
LOCATION_ENTITIES = ("geogName", "placeName", "LOC", "GPE")
TIME_ENTITIES = ("date", "DATE", "time", "TIME")

PROXY_ENTITIES = {
    "who": ("persName",),
    "where": ("geogName", "placeName"),
    "when": ("date",),
}

PLACE_LEMMAS = (
    "las", "ulica", "droga", "autostrada", "skrzyżowanie", "most", "tunel",
    "miasto", "wieś", "miasteczko", "gmina", "powiat", "województwo",
    "region", "centrum", "park", "plac", "osiedle", "dzielnica", "okolica",
    "teren", "miejsce", "granica", "przejście", "przystanek", "dworzec",
    "lotnisko", "stacja", "metro", "stadion", "hala", "magazyn", "fabryka",
    "firma", "biuro", "dom", "mieszkanie", "szpital", "szkoła", "uczelnia",
    "sąd", "komisariat", "komenda", "posterunek", "hotel", "restauracja",
    "klub", "kościół",
)

LOCATION_PREPOSITIONS = (
    "w", "we", "na", "nad", "pod", "przed", "za", "przy", "obok", "koło",
    "między", "pomiędzy", "u", "z", "ze", "do",
)

TIME_PREPOSITIONS = (
    "w", "we", "na", "o", "około", "przed", "po", "od", "do", "między",
    "pomiędzy",
)

TIME_WORDS = ("dziś", "wczoraj", "jutro", "rano", "wieczorem")

DAY_LEMMAS = (
    "poniedziałek", "wtorek", "środa", "czwartek", "piątek", "sobota",
    "niedziela",
)

MONTH_LEMMAS = (
    "styczeń", "luty", "marzec", "kwiecień", "maj", "czerwiec", "lipiec",
    "sierpień", "wrzesień", "październik", "listopad", "grudzień",
)

DASHES = ("–", "-", "—")

# A preposition is not looked for beyond one of these parts of speech.
BOUNDARY_POS = ("PUNCT", "VERB", "AUX", "SCONJ", "CCONJ")

# Function words that carry no content when phrases are compared.
FUNCTION_POS = ("ADP", "DET", "CCONJ", "SCONJ", "PART", "PUNCT", "SPACE")

# Ordered: the first label that differs from the model's and has a hit wins.
KEYWORD_RULES = (
    ("PRZESTEPSTWO", ("napastnik", "pobił", "pobity", "kradzie", "właman", "złodziej", "rabun", "napad")),
    ("WYPADEK", ("wypadek", "zderzy", "uderzy", "potrąci", "kolizj", "samochód", "kierowca", "autobus", "ciężarówk")),
    ("KATASTROFA", ("pożar", "zginę", "wybuch", "katastrof", "zawali", "powódź", "trzęsienie")),
    ("PROTEST", ("protest", "strajk", "manifestac", "demonstrac")),
)
OVERRIDE_BELOW = 0.55
OVERRIDE_CONFIDENCE = 0.90
