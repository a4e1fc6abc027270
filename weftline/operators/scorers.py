"""Models as pluggable columns: what is outside this library comes in as a scorer, and a plain one stands in."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Scorer(Protocol):
    def __call__(self, *columns: Column) -> Column: ...


class Tokenizer(Protocol):
    def tokenize(self, text: Column) -> Column: ...

    def detokenize(self, tokens: Column) -> Column: ...


def drawn(text: Column) -> Column:
    """A number in [0, 1) from a text: the first 32 bits of its MD5."""
    return F.conv(F.left(F.md5(text), F.lit(8)), 16, 10).cast("long") / F.lit(float(1 << 32))


class DigestScorer:
    """A number in [0, 1) from the columns' content, four decimals: deterministic, for tests and dry runs. Nulls are left out."""

    def __init__(self, seed: int = 0) -> None:
        self.seed = seed

    def __call__(self, *columns: Column) -> Column:
        return F.floor(drawn(F.concat_ws("\t", F.lit(str(self.seed)), *columns)) * 10_000) / F.lit(10_000.0)


class SpaceTokenizer:
    """Words and signs; spaces become a mark, so nothing is lost."""

    MARK = "▁"

    def tokenize(self, text: Column) -> Column:
        return F.regexp_extract_all(F.translate(text, " ", self.MARK), F.lit(rf"{self.MARK}|[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{self.MARK}]"), F.lit(0))

    def detokenize(self, tokens: Column) -> Column:
        return F.translate(F.array_join(tokens, ""), self.MARK, " ")


def augment(text: Column, how: str) -> Column:
    """upper or title."""
    return {"upper": F.upper, "title": F.initcap}[how](text)


#: Kinds of end punctuation: both sides of a pair must end in the same kind to lose it.
ENDINGS = (".。", "!！", "?？", "…")


def strip_endings(src: Column, trg: Column) -> tuple[Column, Column]:
    """Both sides without their last sign where both end in the same kind of punctuation; else both as they are."""
    same = F.lit(False)
    for kind in ENDINGS:
        same = same | (F.right(src, F.lit(1)).isin(*kind) & F.right(trg, F.lit(1)).isin(*kind))
    cut = lambda t: F.when(same, F.left(t, F.length(t) - 1)).otherwise(t)
    return cut(src), cut(trg)


#: Scripts by their ISO 15924 code: name, kind of writing system, and whether it has upper and lower case.
SCRIPTS = {
    "Adlm": ("Adlam", "alphabetic", True), "Arab": ("Arabic", "abjad", False), "Armn": ("Armenian", "alphabetic", True), "Beng": ("Bengali", "abugida", False), "Cyrl": ("Cyrillic", "alphabetic", True), "Deva": ("Devanagari", "abugida", False),
    "Ethi": ("Ethiopic", "abugida", False), "Geor": ("Georgian", "alphabetic", False), "Grek": ("Greek", "alphabetic", True), "Gujr": ("Gujarati", "abugida", False), "Guru": ("Gurmukhi", "abugida", False), "Hang": ("Hangul", "featural", False),
    "Hans": ("Simplified Han", "logographic", False), "Hant": ("Traditional Han", "logographic", False), "Hebr": ("Hebrew", "abjad", False), "Jpan": ("Japanese", "logographic", False), "Khmr": ("Khmer", "abugida", False), "Knda": ("Kannada", "abugida", False),
    "Kore": ("Korean", "featural", False), "Laoo": ("Lao", "abugida", False), "Latn": ("Latin", "alphabetic", True), "Mlym": ("Malayalam", "abugida", False), "Mong": ("Mongolian", "alphabetic", False), "Mymr": ("Myanmar", "abugida", False),
    "Nkoo": ("N'Ko", "alphabetic", False), "Olck": ("Ol Chiki", "alphabetic", False), "Orya": ("Odia", "abugida", False), "Sinh": ("Sinhala", "abugida", False), "Taml": ("Tamil", "abugida", False), "Telu": ("Telugu", "abugida", False),
    "Tfng": ("Tifinagh", "alphabetic", False), "Thaa": ("Thaana", "abugida", False), "Thai": ("Thai", "abugida", False), "Tibt": ("Tibetan", "abugida", False), "Vaii": ("Vai", "syllabary", False),
}
PHONEMIC = ("alphabetic", "abjad", "abugida", "syllabary")
#: Languages with their three-letter code and usual script; all others are given by the caller.
LANGUAGES = {"ar": ("ara", "Arab"), "bg": ("bul", "Cyrl"), "ca": ("cat", "Latn"), "cs": ("ces", "Latn"), "de": ("deu", "Latn"), "el": ("ell", "Grek"), "en": ("eng", "Latn"), "es": ("spa", "Latn"), "fi": ("fin", "Latn"), "fr": ("fra", "Latn"), "he": ("heb", "Hebr"), "hi": ("hin", "Deva"), "hu": ("hun", "Latn"), "it": ("ita", "Latn"), "ja": ("jpn", "Jpan"), "ko": ("kor", "Hang"), "lt": ("lit", "Latn"), "nl": ("nld", "Latn"), "pl": ("pol", "Latn"), "pt": ("por", "Latn"), "ru": ("rus", "Cyrl"), "th": ("tha", "Thai"), "uk": ("ukr", "Cyrl"), "zh": ("zho", "Hans")}


def script_of(lang: Column) -> dict[str, Column]:
    """hplt ('rus_Cyrl'), script, kind, bicameral and phonemic of a two-letter language; nulls for unknown ones."""
    look = lambda pairs: F.element_at(F.create_map(*(F.lit(x) for kv in pairs.items() for x in kv)), lang)
    of = {k: SCRIPTS[s] for k, (_, s) in LANGUAGES.items()}
    return {
        "hplt": look({k: f"{a}_{s}" for k, (a, s) in LANGUAGES.items()}), "script": look({k: v[0] for k, v in of.items()}), "kind": look({k: v[1] for k, v in of.items()}),
        "bicameral": look({k: v[2] for k, v in of.items()}), "phonemic": look({k: v[1] in PHONEMIC for k, v in of.items()}),
    }


def _chance(key: Column, seed: int, what: str) -> Column:
    """A number in [0, 1) that depends on the key, the seed and what it is for."""
    return drawn(F.concat_ws(":", F.lit(str(seed)), F.lit(what), key.cast("string")))


def typos(df: DataFrame, column: str, key: str, seed: int = 0, kinds: int = 4) -> DataFrame:
    """df with up to `kinds` kinds of typing errors in a column, each at a place of its own: two signs exchanged, one lost,
    one doubled, one replaced. Each is a projection of its own, so that none repeats the ones before."""
    letter = F.substr(F.lit("etaoinsrhl"), 1 + F.floor(_chance(F.col(key), seed, "letter") * 10).cast("int"), F.lit(1))
    a, b, t = F.substr(F.col(column), F.col("_i"), F.lit(1)), F.substr(F.col(column), F.col("_i") + 1, F.lit(1)), F.col(column)
    steps = {"swap": F.concat(b, a), "drop": b, "double": F.concat(a, a, b), "replace": F.concat(letter, b)}
    for what, middle in list(steps.items())[:kinds]:
        place = 1 + F.floor(_chance(F.col(key), seed, what) * F.greatest(F.length(t) - 1, F.lit(1))).cast("int")
        edited = F.concat(F.substr(t, F.lit(1), F.col("_i") - 1), middle, F.substr(t, F.col("_i") + 2))
        df = df.withColumn("_i", place).withColumn(column, F.when(F.length(t) > 1, edited).otherwise(t))
    return df.drop("_i")


def noise_word(key: Column, seed: int, i: int) -> Column:
    """A made-up word: a stretch of a digest with digits turned into signs."""
    digest = F.md5(F.concat_ws(":", F.lit(f"{seed}:{i}"), key.cast("string")))
    return F.translate(F.left(digest, (2 + F.floor(_chance(key, seed, f"size{i}") * 8)).cast("int")), "0123456789", "ghijk%#@&!")


def noise_pairs(pairs: DataFrame, key: str, seed: int = 0) -> DataFrame:
    """The pairs and as many lines of noise, alike on both sides; `noise` tells them apart."""
    line = F.concat_ws(" ", *(noise_word(F.col(key), seed, i) for i in range(3)))
    made = pairs.withColumns({"src": line, "trg": line, "noise": F.lit(True)})
    return pairs.withColumn("noise", F.lit(False)).unionByName(made)


def inline_noise(src: Column, trg: Column, alignment: Column, key: Column, seed: int = 0) -> tuple[Column, Column]:
    """Both sides with the same made-up word behind a pair of aligned words, which is drawn by key.

    alignment: array of (s, t) word numbers. Pairs without an alignment stay as they are.
    """
    n = F.size(alignment)
    pick = F.get(alignment, F.floor(_chance(key, seed, "pair") * n).cast("int"))
    word = noise_word(key, seed, 0)

    def put(text: Column, i: Column) -> Column:
        w = F.split(text, " ")
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, F.lit(1), i + 1), F.array(word), F.slice(w, i + 2, F.greatest(F.size(w) - i - 1, F.lit(0)))), " ")).otherwise(text)

    return put(src, pick["s"]), put(trg, pick["t"])


def augment_mix(pairs: DataFrame, key: str, bicameral: bool, phonemic: bool, share: float = 0.05, seed: int = 0) -> DataFrame:
    """Pairs with each kind of augmentation for its own share of rows, drawn by key; `how` names the kind, null for none.

    Endings always; titles and upper case for scripts that have case; typing errors in the source for phonemic scripts;
    noise adds rows. Draws of different kinds are apart, and the first that hits is applied.
    """
    k = F.col(key)
    hit = lambda what: _chance(k, seed, what) < share
    how = F.when(hit("punct"), "punct")
    if bicameral:
        how = how.when(hit("title"), "title").when(hit("upper"), "upper")
    if phonemic:
        how = how.when(hit("typos"), "typos")
    a, b = strip_endings(F.col("src"), F.col("trg"))
    d = typos(pairs.withColumn("how", how).withColumn("_typed", F.col("src")), "_typed", key, seed)
    side = lambda c, ending, typing: F.when(F.col("how") == "punct", ending).when(F.col("how") == "title", F.initcap(c)).when(F.col("how") == "upper", F.upper(c)).when(F.col("how") == "typos", typing).otherwise(F.col(c))
    d = d.withColumns({"src": side("src", a, F.col("_typed")), "trg": side("trg", b, F.col("trg"))}).drop("_typed")
    line = F.concat_ws(" ", *(noise_word(k, seed, i) for i in range(3)))
    extra = pairs.where(hit("noise")).withColumns({"src": line, "trg": line, "how": F.lit("noise")})
    return d.unionByName(extra)


def modified(pairs: DataFrame, *steps) -> DataFrame:
    """Pairs through modifiers, each a function from pairs to pairs, in order."""
    for step in steps:
        pairs = step(pairs)
    return pairs


def pivot(text: Column, first: Scorer, second: Scorer) -> Column:
    """A text through two models, by way of a language in between."""
    return second(first(text))
