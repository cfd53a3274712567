"""Word lists, character sets and patterns that results depend on."""

#: punctuation that separates tokens; the straight apostrophe is not among it
PUNCTUATION = '.,;:¡!?"“”‘’()[]{}«»„‚-+=*/@#$%^&|\\<>~`º°ª¿…—–'

ENGLISH_CONTRACTIONS = {
    "ain't": "am not", "aren't": "are not", "can't": "cannot", "could've": "could have",
    "couldn't": "could not", "didn't": "did not", "doesn't": "does not", "don't": "do not",
    "hadn't": "had not", "hasn't": "has not", "haven't": "have not", "he'd": "he would",
    "he'll": "he will", "he's": "he is", "i'd": "i would", "i'll": "i will", "i'm": "i am",
    "i've": "i have", "isn't": "is not", "it'd": "it would", "it'll": "it will", "it's": "it is",
    "let's": "let us", "mustn't": "must not", "shan't": "shall not", "she'd": "she would",
    "she'll": "she will", "she's": "she is", "shouldn't": "should not", "that's": "that is",
    "there's": "there is", "they'd": "they would", "they'll": "they will", "they're": "they are",
    "they've": "they have", "we'd": "we would", "we're": "we are", "we've": "we have",
    "weren't": "were not", "what's": "what is", "where's": "where is", "who's": "who is",
    "won't": "will not", "wouldn't": "would not", "you'd": "you would", "you'll": "you will",
    "you're": "you are", "you've": "you have", "'cause": "because", "how's": "how is",
    "when's": "when is", "why's": "why is", "y'all": "you all", "would've": "would have",
    "should've": "should have", "might've": "might have", "must've": "must have",
}

#: clitics that French drops before a vowel or h
FRENCH_CLITICS = r"(?:[cdjlmnst]|qu)['’]"
FRENCH_VOWELS = "AEIOUYÀÂÄÆÉÈÊËÎÏÔÖÙÛÜŒHaeiouyàâäæéèêëîïôöùûüœh"
PORTUGUESE_CAPITALS = "A-ZÁÉÍÓÚÂÊÔÀÇ"
PORTUGUESE_VOWELS = "aeiouáéíóúâêôàç"

URL = r"http[s]?://(?:[a-zA-Z]|[0-9]|[$-_@.&+]|[!*\\(\\),]|(?:%[0-9a-fA-F][0-9a-fA-F]))+"
EMAIL = r"\b[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Z|a-z]{2,}\b"
WIP_MARKER = r"[\[\{].*(wip|notrad|no trad|no_trad|no-trad).*[\]\}]"
TIME_TOKEN = r"^\d+(PM|AM|PA|AL|MP|AP|RW|BP|KT)$"
LANGUAGE_COLUMN = r"^[a-z]{2}(?:[-_][a-zA-Z]{2})?(?:\s+\(info\))?$"
KEY_COLUMNS = ("key", "definition", "id", "note")
TERM_COLUMNS = ("term", "terminology", "translation", "target")
PLURAL_INFO = r'(?:One|Other|Few|Many|Zero|Two):\s*"([^"]*)"'
LETTER = "A-Za-zÀ-ÖØ-öø-ÿÑñÜü"

#: tokeniser mode of each language
TOKENIZER_MODES = {"en": "english", "pt": "portuguese", "fr": "french", "es": "default", "de": "default", "it": "default"}

#: suffixes and accent-neutral endings that make gender forms, by language
GHOST_SUFFIXES = {
    "es": (("a", "as", "os", "es"), (("ín", "in"), ("ón", "on"), ("án", "an"), ("és", "es"))),
    "pt": (("a", "as", "os", "es", "ões"), (("ão", "ã"), ("ín", "in"), ("ón", "on"), ("ês", "es"))),
    "de": (("in", "innen"), ()),
    "en": ((), ()),
    "fr": ((), ()),
}
SPANISH_NOISE = ("tar", "star", "sir", "over")

#: flags by language: given to every word, tested by quorum, tested by quorum if verbs are asked for,
#: and, kept as configuration only, for names of places and of living things
FLAG_POLICY = {
    "es": {"mandatory": [], "validation": ["S", "G"], "verb": ["R", "E", "I"]},
    "de": {"mandatory": ["S"], "validation": ["F", "p", "P", "R", "N", "E"], "verb": ["I", "X", "Y", "Z", "W"]},
    "en": {"mandatory": [], "validation": ["S"], "verb": ["D", "G", "d"]},
    "pt": {"mandatory": [], "validation": ["B", "D", "F"], "verb": []},
    "fr": {"mandatory": [], "validation": [], "verb": []},
}

#: categories of glossary keys in order of precedence, each with its patterns
KEY_CATEGORIES = {
    "monster": [r"(?i)monster\.\d+\.name", r"(?i)Monster\.name(?:\.\d+)?"],
    "npc": [
        r"(?i)NPC\.\d+\.name",
        r"(?i)taxcollector\.\w+name\.\d+\.\w+",
        r"(?i)document\.\d+\.author",
        r"(?i)Membre de clan\.name\.\d+",
        r"COMPANION_\d+_NAME",
        r"GOD_\d+_NAME",
        r"CHARACTER_NAME_\d+_NAME",
    ],
    "title": [r"(?i)title\.\d+\.(male|female)"],
    "area": [
        r"(?i)area\.\d+\.name",
        r"(?i)subarea\.\d+\.name",
        r"(?i)superarea\.\d+\.name",
        r"(?i)world\.subarea\.\d+\.name",
        r"(?i)world\.\w+\.\d+\.name",
        r"(?i)map\.name\.\d+\.name",
        r"(?i)hint\.\d+\.name",
        r"(?i)Ambience Zone\.name\.\d+",
        r"(?i)Territory_Zone\.name\.\d+",
        r"(?i)Zaap\.\w+name\.\d+",
        r"ZONE_\w+_\d+(?:_\d+)?_NAME",
    ],
    "item": [r"(?i)Item\.name\.\d+", r"(?i)object\.\d+\.name"],
}

#: what custom dictionaries' headers must allow inside words
REQUIRED_WORDCHARS = "'-0123456789"
REQUIRED_TRY = "-'"

#: names of character encodings in affix files
ENCODINGS = {
    "UTF-8": "utf-8", "UTF8": "utf-8", "ISO8859-1": "latin-1", "ISO-8859-1": "latin-1",
    "ISO8859-2": "iso-8859-2", "ISO-8859-2": "iso-8859-2", "ISO8859-15": "iso-8859-15", "ISO-8859-15": "iso-8859-15",
    "KOI8-R": "koi8-r", "KOI8-U": "koi8-u", "CP1251": "cp1251", "WINDOWS-1251": "cp1251", "CP1252": "cp1252", "WINDOWS-1252": "cp1252",
}
