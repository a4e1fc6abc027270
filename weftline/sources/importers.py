"""Importers of published corpora: a dataset key to the files that hold it, and those to rows.

Addresses and names within archives are the publishers'. A location may be mapped to another one (`mocked`), as for tests
or mirrors. Publishers that are asked by a program of their own (MTData, SacreBLEU) are fetchers that the caller gives:
(name, source, target) to both sides' locations, or None where they don't have it.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.operators.clean import collected_lines
from weftline.operators.merge import zipped
from weftline.operators.sample import bounded
from weftline.operators.scorers import LANGUAGES
from weftline.sources import files, remote

#: Where the publishers keep their files.
OPUS = "https://object.pouta.csc.fi/OPUS-{name}"
NEWS_CRAWL = "http://data.statmt.org/news-crawl/{lang}/{name}.{lang}.shuffled.deduped.gz"
FLORES = "https://dl.fbaipublicfiles.com/flores101/dataset/flores101_dataset.tar.gz"
HPLT = "https://data.hplt-project.org/two/cleaned/{locale}_map.txt"
FLORES_CHINESE = {"zh": "zho_simpl", "zh-Hans": "zho_simpl", "zh-Hant": "zho_trad"}


class NotFoundAnywhere(LookupError):
    """No place that an importer knows has the dataset."""


@dataclass(frozen=True)
class Side:
    """A file of lines, or a member of an archive."""

    location: str
    member: str | None = None


Pair = tuple[Side, Side]
Fetcher = Callable[[str, str, str], tuple[str, str] | None]


def iso3(lang: str) -> str:
    """'de' to 'deu'; three letters stay; an unknown language raises."""
    short = lang.split("-")[0].split("_")[0]
    if len(short) == 3:
        return short
    if short not in LANGUAGES:
        raise ValueError(f"no three-letter code known for {lang!r}")
    return LANGUAGES[short][0]


def hplt_locale(lang: str) -> str:
    """'ru' to 'rus_Cyrl'. Languages that aren't in the table must come as locales."""
    return lang if "_" in lang else "_".join((iso3(lang), LANGUAGES[lang][1]))


def opus(name: str, src: str, trg: str) -> list[Pair]:
    """A pair's archive under either order of its languages."""
    corpus, out = name.split("/")[0], []
    for pair in (f"{src}-{trg}", f"{trg}-{src}"):
        archive = f"{OPUS.format(name=name)}/moses/{pair}.txt.zip"
        out.append((Side(archive, f"{corpus}.{pair}.{src}"), Side(archive, f"{corpus}.{pair}.{trg}")))
    return out


def url(name: str, src: str, trg: str) -> list[Pair]:
    return [(Side(files.resolve(name, lang=src)), Side(files.resolve(name, lang=trg)))]


def flores(name: str, src: str, trg: str) -> list[Pair]:
    side = lambda lang: Side(FLORES, f"flores101_dataset/{name}/{FLORES_CHINESE.get(lang) or iso3(lang)}.{name}")
    return [(side(src), side(trg))]


def suffixes(name: str, src: str, trg: str) -> tuple[str, str]:
    """The language codes that end an MTData name, in the order of (src, trg): 'x-v1-eng-zho_CN' for (zh, en) gives (zho_CN, eng)."""
    codes = name.split("-")[-2:]
    for a, b in (codes, codes[::-1]):
        if a.startswith(iso3(src)) and b.startswith(iso3(trg)):
            return a, b
    raise ValueError(f"languages of {name!r} are not {src} and {trg}")


def fetched(fetch: Fetcher, name: str, src: str, trg: str, tries: int = 3) -> Pair:
    """What a publisher's program gives in this direction or in the other; a try that raises is made again."""
    for flip in (False, True):
        for left in reversed(range(tries)):
            try:
                got = fetch(name, *((trg, src) if flip else (src, trg)))
                break
            except OSError:
                if not left:
                    raise
        if got:
            a, b = (Side(x) for x in got)
            return (b, a) if flip else (a, b)
    raise NotFoundAnywhere(f"{name} for {src} and {trg}")


PARALLEL = {"opus": opus, "url": url, "flores": flores}


def split_key(key: str) -> tuple[str, str]:
    """'opus_Books/v1' to ('opus', 'Books/v1')."""
    importer, _, name = key.partition("_")
    if not importer or not name:
        raise ValueError(f"{key!r} is no importer and name joined by an underscore")
    return importer, name


def parallel(spark: SparkSession, key: str, src: str, trg: str, mocked: dict[str, str] | None = None, fetchers: dict[str, Fetcher] | None = None, **how) -> DataFrame:
    """(dataset, pos, src, trg) of a corpus from the first place that has it; raises where none has, or sides differ in length."""
    importer, name = split_key(key)
    if importer in (fetchers or {}):
        options = [fetched(fetchers[importer], name, src, trg)]
    elif importer in PARALLEL:
        options = PARALLEL[importer](name, src, trg)
    else:
        raise ValueError(f"no importer {importer!r}")
    at = lambda s: files.resolve(s.location, mocked)
    found = next((p for p in options if all(remote.exists(spark, at(s)) for s in p)), None)
    if found is None:
        raise NotFoundAnywhere(f"{key} for {src} and {trg}")
    sides = {n: remote.read(spark, at(s), s.member, **how).select(F.col("line_no").alias("pos"), "text") for n, s in zip(("src", "trg"), found, strict=True)}
    return zipped(sides).select(F.lit(key).alias("dataset"), "pos", "src", "trg")


def shards(spark: SparkSession, locale: str, mocked: dict[str, str] | None = None, **how) -> list[str]:
    """A crawl's shards in an order that depends on the name of their list only; the list has a line a shard."""
    listed = HPLT.format(locale=locale)
    lines = remote.read(spark, files.resolve(listed, mocked), **how).collect()
    return [files.resolve(x, mocked) for x in files.shuffled_paths((r.text.strip() for r in lines if r.text.strip()), zlib.crc32(listed.encode()))]


def scored_documents(spark: SparkSession, locations: list[str], **how) -> DataFrame:
    """(doc_id, file, lang, doc_scores, seg_langs, text): documents of shards, a JSON line each, numbered in the shards' order."""
    rank = F.create_map(*(x for i, u in enumerate(locations) for x in (F.lit(_plain(u)), F.lit(i))))
    lines = remote.read(spark, locations, **how)
    d = lines.select("file", "line_no", F.from_json("text", files.DOCUMENT_SCHEMA).alias("d"))
    at = F.element_at(rank, F.regexp_replace("file", "^file:/*", "/")).cast("long") * (1 << 40)
    return d.select((at + F.col("line_no")).alias("doc_id"), "file", "d.*")


def _plain(location: str) -> str:
    return location if remote.is_remote(location) else "/" + location.removeprefix("file:").lstrip("/")


def mono(spark: SparkSession, key: str, lang: str, most: int, mocked: dict[str, str] | None = None, least_score: float = 5.0, longest: int = 600, **how) -> DataFrame:
    """(dataset, text): at most `most` lines of a corpus, a sample that depends on its name only, or a crawl's first merged lines."""
    importer, name = split_key(key)
    if importer == "hplt":
        if name != "mono/v2.0":
            raise ValueError("of this crawl only version 2.0 is known: hplt_mono/v2.0")
        locale = hplt_locale(lang)
        kept, _ = collected_lines(scored_documents(spark, shards(spark, locale, mocked, **how), **how), locale, least_score, longest, most)
        return kept.select(F.lit(key).alias("dataset"), "text")
    places = {"url": name, "news-crawl": NEWS_CRAWL.format(lang=lang, name=name), "opus": f"{OPUS.format(name=name)}/mono/{lang}.txt.gz"}
    if importer not in places:
        raise ValueError(f"no importer {importer!r}")
    lines = remote.read(spark, files.resolve(places[importer], mocked), **how)
    return bounded(lines.select("text", "line_no"), most, zlib.crc32(name.encode()), F.concat_ws(" ", "text", "line_no")).select(F.lit(key).alias("dataset"), "text")


def continuation(spark: SparkSession, src: str, trg: str, tokenized: tuple[str, str, str] | None = None, **how) -> DataFrame:
    """(pos, src, trg) of an earlier run's corpus, with (tok_src, tok_trg, aln) where given: all three or none."""
    places = {"src": src, "trg": trg}
    if tokenized and any(tokenized):
        if not all(tokenized):
            raise ValueError("a tokenised corpus needs both sides and their alignment")
        places |= dict(zip(("tok_src", "tok_trg", "aln"), tokenized, strict=True))
    return zipped({n: remote.read(spark, x, **how).select(F.col("line_no").alias("pos"), "text") for n, x in places.items()})
