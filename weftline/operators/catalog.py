"""Queries over catalogues of corpora, models and versions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftline.functions.text import corpus_name, search_terms
from weftline.operators.sample import ranked

#: Parts of names that are skipped.
SKIPPED = ("CCMatrix", "MultiMaCoCu", "MultiHPLT", "WikiTitles", "swedish_work_environment", "lithuanian_legislation_seimas_lithuania", "ntrex", "SPC", "flores101_dev", "flores101_devtest", "flores200_dev", "flores200_devtest", "WMT-News", "wmt08")
LEAST_SENTENCES, LONGEST_NAME = 200, 80


def skip_reason(name: Column, sentences: Column) -> Column:
    """skipped, too_small, too_long or null, the first that holds."""
    listed = F.lit(False)
    for s in SKIPPED:
        listed = listed | name.contains(s)
    return F.when(listed, "skipped").when(sentences < LEAST_SENTENCES, "too_small").when(F.length(name) > LONGEST_NAME, "too_long")


def not_visited(catalog: DataFrame, visited: DataFrame, excluded: tuple[str, ...] = ("opus", "newstest", "unv1")) -> DataFrame:
    """Entries whose name holds no excluded word and whose normal form hasn't been seen."""
    x = catalog
    for e in excluded:
        x = x.where(~F.lower("name").contains(e))
    seen = visited.select(corpus_name(F.col("name")).alias("_key")).distinct()
    return x.withColumn("_key", corpus_name(F.col("name"))).join(seen, "_key", "left_anti").drop("_key")


def search(df: DataFrame, query: str) -> DataFrame:
    """Rows that match a search: all terms somewhere in the row, key:value within a column; unknown columns are ignored."""
    filters, terms = search_terms(query)
    row = F.lower(F.concat_ws(" ", *(F.col(c).cast("string") for c in df.columns)))
    for t in terms:
        df = df.where(row.contains(t))
    for key, value, negated in filters:
        if key in df.columns:
            hit = F.coalesce(F.lower(F.col(key).cast("string")).contains(value), F.lit(False))
            df = df.where(~hit if negated else hit)
    return df


def version_key(version: Column) -> Column:
    """A struct that orders versions: numbers, then releases above betas, then the beta's name."""
    parts = F.split(version, r"\.")
    padded = F.slice(F.concat(F.array_repeat(F.lit("0"), 3), parts), -3, 3)
    last = F.get(padded, F.lit(2))
    beta = F.regexp_extract(last, r"^\d+([a-z]\d?)", 1)
    return F.struct(F.get(padded, F.lit(0)).cast("int").alias("major"), F.get(padded, F.lit(1)).cast("int").alias("minor"), F.regexp_extract(last, r"^(\d+)", 1).cast("int").alias("patch"), (beta == "").cast("int").alias("release"), beta.alias("beta"))


def latest_versions(models: DataFrame) -> DataFrame:
    return models.groupBy("lang").agg(F.max_by("version", version_key(F.col("version"))).alias("version"))


def model_pairs(models: DataFrame, pivot: str = "en") -> DataFrame:
    """(lang, version, to_pivot, from_pivot): whether there are models both ways."""
    lang = F.when(F.col("src") == pivot, F.col("trg")).otherwise(F.col("src"))
    return models.withColumn("lang", lang).groupBy("lang", "version").agg(F.count_if(F.col("trg") == pivot).alias("to_pivot"), F.count_if(F.col("src") == pivot).alias("from_pivot"))


def language_counts(models: DataFrame) -> DataFrame:
    """(channel, languages, only_here): languages of a channel, and those that no other channel has."""
    x = models.select("channel", "lang").distinct().withColumn("n", F.count("*").over(Window.partitionBy("lang")))
    return x.groupBy("channel").agg(F.count("*").alias("languages"), F.count_if(F.col("n") == 1).alias("only_here"))


def by_size(catalog: DataFrame, name: str = "name") -> DataFrame:
    """Largest size class first, then most downloads, then by name; `place` counts from 1. Size classes are whole numbers."""
    return ranked(catalog, -F.col("size_class"), F.desc("downloads"), F.col(name)).withColumn("place", F.col("rank") + 1).drop("rank", "total")


def without_tag(df: DataFrame, word: str, tags: str = "tags") -> DataFrame:
    """Entries of which no tag holds the word."""
    return df.where(~F.exists(tags, lambda t: t.contains(word)))


def language_tags(tags: Column) -> Column:
    """How many tags name a language."""
    return F.size(F.filter(tags, lambda t: F.startswith(t, F.lit("language:"))))


def news_entries(page: Column) -> Column:
    """(year, bytes) of the files that an index page links, whose sizes are written with K, M or G."""
    rows = F.regexp_extract_all(page, F.lit(r"news\.[0-9]{4}\.[^<]*</a>(?:<[^>]*>|\s)*[0-9.]+[KMG]"), F.lit(0))
    number = lambda r: F.regexp_extract(r, r"([0-9.]+)[KMG]$", 1).cast("double")
    unit = lambda r: F.when(F.endswith(r, F.lit("K")), 1e3).when(F.endswith(r, F.lit("M")), 1e6).otherwise(1e9)
    return F.transform(rows, lambda r: F.struct(F.regexp_extract(r, r"news\.([0-9]{4})", 1).cast("long").alias("year"), F.round(number(r) * unit(r)).cast("long").alias("bytes")))


def arguments(line: Column) -> Column:
    """A command's options as a map from name to values: a flag is 'true', and all words behind a name are its values."""
    parts = F.filter(F.split(F.concat(F.lit(" "), F.trim(line)), r" --"), lambda p: p != "")
    entry = lambda p: F.struct(F.split_part(p, F.lit(" "), F.lit(1)).alias("key"), F.when(F.instr(p, " ") == 0, F.array(F.lit("true"))).otherwise(F.slice(F.split(p, " +"), F.lit(2), F.size(F.split(p, " +")) - 1)).alias("value"))
    return F.map_from_entries(F.transform(parts, entry))


def merged_config(left: Column, right: Column) -> Column:
    """Both maps' entries; where both have one, the right one's."""
    kept = F.map_filter(left, lambda k, _: ~F.map_contains_key(right, k))
    return F.map_concat(kept, right)


def listed(df: DataFrame, name: str, excluded: list[str]) -> DataFrame:
    """(name): distinct names in order, without those that hold an excluded string in any case."""
    kept = df.where(~reduce(Column.__or__, (F.contains(F.lower(name), F.lit(x.lower())) for x in excluded))) if excluded else df
    return kept.select(name).distinct().orderBy(name)


def table_lines(df: DataFrame, columns: list[str]) -> DataFrame:
    """(line): rows as text in columns of equal width; widths come from one aggregate, nothing is collected."""
    shown = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in columns))
    width = shown.agg(*(F.greatest(F.max(F.length(c)), F.lit(len(c))).alias(f"_{c}") for c in columns))
    return shown.crossJoin(F.broadcast(width)).select(F.concat_ws(" ", *(F.rpad(c, F.col(f"_{c}"), F.lit(" ")) for c in columns)).alias("line"))


def by_text(df: DataFrame, column: str, down: bool = False) -> DataFrame:
    """Rows in the order of a column's text, either way; nulls come as empty texts."""
    key = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return df.orderBy(key.desc() if down else key.asc())


def usable_sources(df: DataFrame, pair: str, lang_pair: str = "lp", bad: str = "is_bad_source") -> DataFrame:
    """Rows of one language pair whose source isn't marked as bad; rows without a mark go too."""
    return df.where(~F.col(bad) & (F.col(lang_pair) == pair))


CORPORA = "corpora array<struct<corpus string, version string, source string, target string, alignment_pairs long, size long, url string>>"


def opus_entries(answers: DataFrame, column: str = "value") -> DataFrame:
    """A row each of the corpora in a catalogue's JSON answers: (corpus, version, source, target, alignment_pairs, size, url, key).

    Entries without pairs are no corpora and go; key is 'opus_<corpus>/<version>'. Answers that aren't JSON give no rows.
    """
    e = answers.select(F.explode(F.from_json(column, CORPORA)["corpora"]).alias("e")).select("e.*").where("alignment_pairs > 0")
    return e.withColumn("key", F.concat(F.lit("opus_"), "corpus", F.lit("/"), "version"))
