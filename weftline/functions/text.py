"""Text rewrites and key functions as Column expressions."""

from __future__ import annotations

import re
from unicodedata import is_normalized, normalize

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: What str.strip() and str.split() take for white space, inside a character class; for Java and for RE2.
SPACE = r"\s\x0B\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_RE2 = r"\s\x0B\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"

#: Entities and what they stand for, in the order of replacement.
ENTITIES = [("&bar;", "|"), ("&#124;", "|"), ("&lt;", "<"), ("&gt;", ">"), ("&bra;", "["), ("&ket;", "]"), ("&quot;", '"'), ("&apos;", "'"), ("&#91;", "["), ("&#93;", "]"), ("&amp;", "&")]

#: Pattern and replacement of the fixes of single datasets. A sentence's last sign may be any character.
DATASET_FIXES = {
    "mtdata_OPUS_DOGC_v2.ca": [(r"([lndsLNDS]) ' ([a-zA-Z1])", "$1'$2"), (r"([0-9]) ?/ ?([0-9])", "$1/$2"), (r"([a-z]) .$", "$1."), ("l · l", "l·l")],
    "mtdata_OPUS_DOGC_v2.es": [(r"([0-9]) ?/ ?([0-9])", "$1/$2"), (r"([a-z]) .$", "$1.")],
    "mtdata_OPUS_UNPC_v1_0.en": [(r"([a-z]) ' ([s])", "$1'$2")],
    "mtdata_OPUS_UNPC_v1_0.fr": [(r"([lndsLNDS]) ' ([a-zA-Z])", "$1'$2")],
    "mtdata_JW300.mt": [(r" - \u200b ", "-"), (" - ", "-")],
    "mtdata_neulab_tedtalksv1_train.ro": [(r"(\w) - (\w)", "$1-$2")],
}


def strip(text: Column) -> Column:
    return F.regexp_replace(text, rf"^[{SPACE}]+|[{SPACE}]+$", "")


def nfc(text: Column) -> Column:
    """Canonical composition; Spark has no built-in. Text that is composed already, as nearly all is, only gets a check."""

    @F.pandas_udf("string")
    def run(column: pd.Series) -> pd.Series:
        return column.map(lambda t: t if t is None or t.isascii() or is_normalized("NFC", t) else normalize("NFC", t))

    return run(text)


def norm_key(text: Column) -> Column:
    """The key under which texts count as the same."""
    return nfc(strip(text))


def deescape(text: Column) -> Column:
    for entity, sign in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(sign))
    return text


def strip_nonprinting(text: Column) -> Column:
    return F.regexp_replace(text, r"\p{C}", " ")


def fix_dataset(text: Column, dataset: str) -> Column:
    for pattern, to in DATASET_FIXES.get(dataset, []):
        text = F.regexp_replace(text, pattern, to)
    return text


def last_line(text: Column) -> Column:
    """The last line of a text, both stripped of white space."""
    return strip(F.element_at(F.split(strip(text), "\n"), -1))


def words(text: Column) -> Column:
    """Words between white space."""
    return F.array_remove(F.split(text, rf"[{SPACE}]+"), "")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(rf"[^{SPACE}]+"))


def format_bytes(size: Column) -> Column:
    """1000-based size with one decimal."""
    units = F.array(*(F.lit(u) for u in ("B", "KB", "MB", "GB", "TB", "PB", "EB")))
    index = F.floor(F.least(F.lit(20), F.length(F.abs(size).cast("string")) - 1) / 3).cast("int")
    scaled = F.round(size / F.pow(F.lit(1000.0), index), 1)
    return F.when(size == 0, F.lit("0 B")).otherwise(F.concat_ws(" ", scaled.cast("decimal(20,1)").cast("string"), F.get(units, index)))


def dataset_key(key: Column) -> tuple[Column, Column]:
    """(importer, name): cut at the first underscore; both nulls unless both parts are there."""
    importer = F.split_part(key, F.lit("_"), F.lit(1))
    at = F.instr(key, "_")
    name = F.substr(key, at + 1)
    ok = (at > 1) & (name != "")
    return F.when(ok, importer), F.when(ok, name)


def sanitize_dataset(name: Column, longest: int = 50) -> Column:
    """A dataset's name for labels: URLs become host_file_digest, long names are cut and marked by a digest."""
    digest = F.left(F.md5(name), F.lit(6))
    host = F.regexp_extract(name, r"^https?://([^/:?#]+)", 1)
    host = F.when(host == "storage.googleapis.com", "gcp").otherwise(host)
    file = F.regexp_extract(F.regexp_replace(name, r"[?#].*$", ""), r"([^/]*)$", 1)
    stem = F.regexp_replace(file, r"(?<=.)\.[^.]*$", "")
    stem = F.replace(F.replace(stem, F.lit(".[LANG]"), F.lit("")), F.lit("[LANG]"), F.lit(""))
    short = F.when(name.rlike("^https?://"), F.concat_ws("_", host, stem, digest)).when(F.length(name) > longest, F.concat_ws("_", F.left(name, F.lit(longest)), digest)).otherwise(name)
    return F.regexp_replace(short, r"://|[/.:\[\]]", "_")


def import_id(key: Column) -> tuple[Column, Column, Column]:
    """(importer, augmentation, dataset)."""
    pattern = r"^([a-z]*)_(aug[a-z\-]*)?_?(.+)$"
    part = lambda i: F.when(key.rlike(pattern), F.nullif(F.regexp_extract(key, pattern, i), F.lit("")))
    return part(1), part(2), part(3)


def corpus_name(name: Column) -> Column:
    """Lower-case letters of a corpus name, without language codes and a last 'train'."""
    name = F.lower(F.regexp_replace(name, r"-\w{3}-\w{3}$", ""))
    return F.regexp_replace(F.regexp_replace(name, "[^a-z]", ""), "train$", "")


def estimate_sentences(size: Column) -> Column:
    """Sentences from compressed bytes."""
    return F.floor(size / 113).cast("long")


def search_terms(query: str) -> tuple[list[tuple[str, str, bool]], list[str]]:
    """key:value filters (key, value, negated) and free terms of a search; values may be quoted."""
    filters, terms = [], []
    for sign, key, value, free in re.findall(r'(?:^|(?<=\s))(?:(-?)(\w+):("[^"]+"|\S+)|("[^"]+"|\S+))', query.strip()):
        text = (value or free).strip('"').strip().lower()
        if text and key:
            filters.append((key.lower(), text, bool(sign)))
        elif text:
            terms.append(text)
    return filters, terms
