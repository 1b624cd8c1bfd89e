"""Name normalisers and text measures as column expressions. Each normaliser is a different one; see its docstring."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accented Latin letters and their bare forms, in the same order.
ACCENTED = "àáâãäåèéêëìíîïòóôõöùúûüýÿñçāēīōūÀÁÂÃÄÅÈÉÊËÌÍÎÏÒÓÔÕÖÙÚÛÜÝÑÇĀĒĪŌŪ"
BARE = "aaaaaaeeeeiiiiooooouuuuyyncaeiouAAAAAAEEEEIIIIOOOOOUUUUYNCAEIOU"
#: Letters that become several.
LIGATURES = {"ß": "ss", "æ": "ae", "œ": "oe", "Æ": "AE", "Œ": "OE", "ª": "a", "º": "o"}
#: Words that a core name leaves out (fixed values; a parameter wherever it is used).
ARTICLES = ("de", "del", "dels", "des", "la", "el", "els", "les", "es", "sa", "ses", "sos", "s", "d", "l", "na", "en", "lo", "y", "i", "los", "las")
#: Spellings taken as the same sound, replaced in this order (fixed values).
FOLDS = (("ny", "n"), ("ll", "y"), ("tx", "x"), ("itj", "x"), ("ig", "x"), ("ss", "s"), ("v", "b"), ("h", ""))


def without_accents(c: Column) -> Column:
    return F.translate(c, ACCENTED, BARE)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, " +", " "))


def norm(c: Column) -> Column:
    """Transliterated to ASCII, lower case, other characters one space."""
    c = without_accents(c)
    for a, b in LIGATURES.items():
        c = F.replace(c, F.lit(a), F.lit(b))
    return squeeze(F.regexp_replace(F.lower(c), "[^a-z0-9]", " "))


def audit_norm(c: Column) -> Column:
    """Accents and other non-ASCII characters dropped, lower case, runs of others one space."""
    return squeeze(F.regexp_replace(F.lower(F.regexp_replace(without_accents(c), "[^\\x00-\\x7F]", "")), "[^a-z0-9]+", " "))


def bare_letters(texts):
    """A pandas function: texts decomposed (NFD) without their combining marks; ASCII ones as they are."""
    import unicodedata

    return texts.map(lambda s: s if s is None or s.isascii() else "".join(ch for ch in unicodedata.normalize("NFD", s) if unicodedata.category(ch) != "Mn"))


def without_marks(c: Column) -> Column:
    """Any script's letters without combining marks. Letters beyond ASCII that the table of ``without_accents`` leaves go through an Arrow function; other texts never leave the JVM."""
    plain = without_accents(c)
    return F.when(plain.rlike("[^\\x00-\\x7F]"), F.pandas_udf(bare_letters, "string")(plain)).otherwise(plain)


def loose_norm(c: Column) -> Column:
    """Marks dropped, lower case; letters, digits and spaces stay as they are."""
    return F.regexp_replace(F.lower(without_marks(c)), "[^\\p{L}\\p{N} ]", "")


def gcp_norm(c: Column) -> Column:
    """Lower case without marks; punctuation stays."""
    return F.lower(without_marks(c))


def key(c: Column) -> Column:
    """Circumflex, macron and tilde vowels made plain; any other character than a-z and 0-9 a space."""
    return squeeze(F.regexp_replace(F.translate(F.lower(c), "âêîôûāēīōūãõ", "aeiouaeiouao"), "[^a-z0-9]", " "))


def remap_key(c: Column) -> Column:
    """As ``key``, with circumflex vowels only."""
    return squeeze(F.regexp_replace(F.translate(F.lower(c), "âêîôû", "aeiou"), "[^a-z0-9]", " "))


def macronize(c: Column) -> Column:
    """Circumflex and tilde vowels become macron vowels."""
    return F.translate(c, "âêîôûãõÂÊÎÔÛÃÕ", "āēīōūāōĀĒĪŌŪĀŌ")


def core(c: Column, articles: tuple[str, ...] = ARTICLES) -> Column:
    """``norm`` without article words, order kept."""
    return F.array_join(F.filter(F.split(norm(c), " "), lambda x: ~x.isin(*articles)), " ")


def fold(c: Column) -> Column:
    """Spelling variants of a core made one; doubled characters single."""
    for a, b in FOLDS:
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.regexp_replace(c, "(.)\\1+", "$1")


def sorted_tokens(c: Column) -> Column:
    return F.array_join(F.sort_array(F.split(c, " ")), " ")


def lev_ratio(a: Column, b: Column) -> Column:
    """1 - Levenshtein distance / longer length; 1 for two empty strings."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest == 0, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longest)


def letter_marks(c: Column) -> Column:
    """A set of the characters as 64 bits; k edits change at most 2 k of them, so sets that differ in more bits need no edit distance."""
    return F.aggregate(F.split(c, ""), F.lit(0).cast("long"), lambda a, x: a.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(x) % 64)))


#: Circumflex, macron and tilde vowels of both cases and their bare forms (fixed values).
MARKED, UNMARKED = "âêîôûāēīōūãẽĩõũ", "aeiouaeiouaeiou"


def title_first(c: Column) -> Column:
    """A name with its words a space apart: a first word so or ca (whatever its marks, dots and commas) becomes Son or Can; the others lose circumflex, macron and tilde marks in lower case."""
    words = F.filter(F.split(c, "(?U)\\s+"), lambda w: w != "")
    plain = lambda w: F.translate(w, MARKED, UNMARKED)
    head = plain(F.btrim(F.lower(F.get(words, F.lit(0))), F.lit(".,")))
    return F.array_join(F.transform(words, lambda w, i: F.when((i == 0) & (head == "so"), "Son").when((i == 0) & (head == "ca"), "Can").otherwise(plain(w))), " ")


#: The towns that a name alone can place, and the heads of castle names (fixed values).
CITIES = ("mallorca", "palma", "alcudia", "alcvdia")
CASTLES = ("castell", "castillo")


def kind_of(key: Column) -> Column:
    """The class that a key tells: a city by itself or by its first word, a castle by its first word, else altre."""
    head = F.substring_index(key, " ", 1)
    return F.when(head.isin(*CITIES) | key.isin(*CITIES), "Ciutat").when(head.isin(*CASTLES), "Castell").otherwise("altre")


def natural(c: Column, width: int = 12) -> Column:
    """A sort key: folded, with each number padded, so that 2 comes before 10. Empty and null give null, to be put last either way."""
    padded = F.regexp_replace(norm(c), "([0-9]+)", "0" * width + "$1")
    return F.nullif(F.regexp_replace(padded, "0*([0-9]{" + str(width) + "})", "$1"), F.lit(""))


def below(base: str, path: Column) -> Column:
    """A path under a base, with one slash between."""
    return F.concat(F.lit(base.rstrip("/") + "/"), F.ltrim(path, F.lit("/")))


def km_text(c: Column) -> Column:
    """One decimal and the unit; nothing for null."""
    return F.when(c.isNull(), "").otherwise(F.concat(F.format_string("%.1f", c), F.lit(" km")))


def grouped(c: Column) -> Column:
    """A whole number with dots between thousands."""
    return F.translate(F.format_number(c, 0), ",", ".")


def html_escape(c: Column) -> Column:
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def lcs_ratio(left, right):
    """A pandas function: 2 LCS / (len + len) of two string columns, 0 where one is empty. Bit-parallel, once a distinct pair."""
    import pandas as pd

    def one(a: str, b: str) -> float:
        if not a or not b:
            return 0.0
        at: dict[str, int] = {}
        for i, ch in enumerate(a):
            at[ch] = at.get(ch, 0) | 1 << i
        full = (1 << len(a)) - 1
        v = full
        for ch in b:
            u = v & at.get(ch, 0)
            v = ((v + u) | (v - u)) & full
        return 2 * (len(a) - v.bit_count()) / (len(a) + len(b))

    known: dict[tuple[str, str], float] = {}
    out = []
    for pair in zip(left.fillna(""), right.fillna("")):
        if pair not in known:
            known[pair] = one(*pair)
        out.append(known[pair])
    return pd.Series(out, dtype="float64")


def indel_ratio(a: Column, b: Column) -> Column:
    return F.pandas_udf(lcs_ratio, "double")(a, b)


def phonetic_key(names):
    """A pandas function: a consonant key of each word longer than two letters, by the published Metaphone rules for the commoner cases."""
    import re

    rules = ((r"^(?:kn|gn|pn|ae|wr)", lambda m: m[0][1]), (r"mb$", "m"), (r"sch", "sk"), (r"c(?=ia)|ch|t(?=i[ao])|s(?=i[ao])|sh", "X"), (r"c(?=[iey])", "s"), (r"c|q", "k"), (r"d(?=g[eiy])", "j"), (r"d", "t"), (r"gh(?=[^aeiou]|$)", ""), (r"g(?=[iey])", "j"), (r"g", "k"), (r"ph", "f"), (r"th", "0"), (r"v", "f"), (r"x", "ks"), (r"z", "s"), (r"[wy](?![aeiou])", ""), (r"(?<=[aeiou])h(?![aeiou])", ""))

    def word(w: str) -> str:
        for a, b in rules:
            w = re.sub(a, b, w)
        return re.sub(r"(.)\1+", r"\1", w[:1] + re.sub("[aeiou]", "", w[1:])).upper()

    return names.fillna("").map(lambda s: " ".join(word(w) for w in s.split(" ") if len(w) > 2))


def metaphone_key(c: Column) -> Column:
    return F.pandas_udf(phonetic_key, "string")(c)
