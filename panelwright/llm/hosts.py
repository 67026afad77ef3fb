"""URL filter: rules first, then naive Bayes over words that host names are split into.

Word counts, token counts and log-odds are stored tables of any size. Rows are joined to them, rows of frequent words and
tokens without being moved, so nothing is left out of the models and no task holds one of them whole.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from panelwright.operators.joins import lookup
from panelwright.session import stored

# Letters of the longest word that a name is split into.
LONGEST_WORD = 20
# Log-odds are added up in billionths, so that no order of adding changes a verdict; rows that leave a task at once.
UNIT, ROWS = 1_000_000_000, 50_000
_LETTERS = r"[^\W\d_]+"
_WORDS, _TAGS = re.compile(_LETTERS), re.compile("<[^>]*>")
_HOST, _PATH = re.compile(rf"{_LETTERS}|[0-9]+|[^.-]"), re.compile(rf"{_LETTERS}|[0-9]+")


def host_and_path(url: str = "url") -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://`` or for a null url."""
    rest = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"(?s)^.*?://([^/?#]*)([^?#]*)", 2)
    return F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def ruled(rules: list[tuple[str, str]], host: str = "host", path: str = "path") -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does. A rule is (verdict, host/path start)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        name, slash, start = text.partition("/")
        inside = (F.col(host) == name) | F.col(host).endswith(f".{name}")
        fits = inside & F.col(path).startswith(slash + start)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of a bounded size."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == ROWS:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)
            held = []
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema.names)


def dictionary(pages: DataFrame, html: str = "html") -> DataFrame:
    """(word, n): all words of all page texts, letters of any script in lower case; the unigram counts of the segmentation."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("word", pa.string()), ("n", pa.int64())])
        for batch in batches:
            for first in range(0, batch.num_rows, 256):
                found: Counter[str] = Counter()
                for text in batch.column(0).slice(first, 256).to_pylist():
                    found.update(w for w in _WORDS.findall(_TAGS.sub(" ", text or "").lower()) if len(w) <= LONGEST_WORD)
                yield from _batches(found.items(), schema)

    return pages.select(html).mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def split_words(name: str, model: dict[str, float]) -> list[str]:
    """The most probable split of a name into words, by Viterbi; ties go to the longer last word.

    An unknown stretch of n letters counts 10 to the minus n of a word seen once in a million, so that every name has a split.
    """
    best, back = [0.0], [0]
    for end in range(1, len(name) + 1):
        top, at = -math.inf, 0
        for first in range(max(0, end - LONGEST_WORD), end):
            word = name[first:end]
            own = best[first] + model.get(word, -(6 + len(word)) * math.log(10))
            if own > top:
                top, at = own, first
        best.append(top)
        back.append(at)
    out, end = [], len(name)
    while end:
        out.append(name[back[end] : end])
        end = back[end]
    return out[::-1]


def features(urls: DataFrame) -> DataFrame:
    """(_place, verdict, f, c): what a url is made of, and how often. ``r:`` marks a run of letters of the host, which is yet to be
    split into words, ``h:`` any other part of it, ``p:`` a word of the path (percent signs decoded); all numbers of a path are one.
    """

    def parts(host: str, path: str) -> Iterator[str]:
        for part in _HOST.findall(host):
            yield f"r:{part}" if _WORDS.fullmatch(part) else f"h:{part}"
        for part in _PATH.findall(unquote(path, errors="replace").lower()):
            yield "p:0" if part[0] in "0123456789" else f"p:{part}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("_place", pa.int64()), ("verdict", pa.string()), ("f", pa.string()), ("c", pa.int64())])
        for batch in batches:
            urls = zip(*[c.to_pylist() for c in batch.columns], strict=True)
            yield from _batches(((k, v, f, c) for k, v, host, path in urls for f, c in Counter(parts(host, path)).items()), schema)

    return urls.select("_place", "verdict", "host", "path").mapInArrow(run, "_place long, verdict string, f string, c long")


def segmented(runs: DataFrame, words: DataFrame) -> DataFrame:
    """(run, parts) of different runs of letters, split by Viterbi with the counts (word, n) of those words that a run contains.

    Of a run its known parts meet in one row, at most LONGEST_WORD for each of its letters.
    """
    total = words.agg(F.sum("n")).first()[0] or 1

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("run", pa.string()), ("w", pa.string())])
        for batch in batches:
            yield from _batches(((run, w) for run in batch.column(0).to_pylist() for w in {
                run[a : a + n] for a in range(len(run)) for n in range(1, min(LONGEST_WORD, len(run) - a) + 1)}), schema)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("run", pa.string()), ("parts", pa.list_(pa.string()))])
        for batch in batches:
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
            yield from _batches(((run, split_words(run, {x["w"]: math.log(x["n"] / total) for x in known})) for run, known in rows), schema)

    known = lookup(runs.mapInArrow(inside, "run string, w string"), words, {"w": "word"}, "words")
    # Parts that are no words are left out of the list, but keep their run.
    each = known.groupBy("run").agg(F.collect_list(F.when(F.col("n").isNotNull(), F.struct("w", "n"))).alias("known"))
    return each.mapInArrow(split, "run string, parts array<string>")


def scores(urls: DataFrame, words: DataFrame) -> DataFrame:
    """(_place, verdict, ..., score): log-odds of blocking under multinomial naive Bayes of all rows that a rule judged.

    Add-one smoothing; tokens that no judged row has tell nothing. Without rows of both verdicts there is nothing to learn,
    and every score is -1.
    """
    rows = {r["verdict"]: r["n"] for r in urls.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
    good, bad = rows.get("allow", 0), rows.get("block", 0)
    if not good or not bad:
        return urls.withColumn("score", F.lit(-1.0))
    found = stored(features(urls), "features")

    def of(kind: str) -> Column:
        return F.sum(F.when(F.col("verdict") == kind, F.col("c")).otherwise(0)).alias(kind)

    counts = stored(found.groupBy("f").agg(of("allow"), of("block")), "feature-counts")
    is_run = F.col("f").startswith("r:")
    runs = stored(counts.filter(is_run).select(F.substring("f", 3, 1 << 30).alias("run")), "runs")
    named = segmented(runs, words).select(F.concat(F.lit("r:"), "run").alias("f"), F.explode("parts").alias("w"))
    pieces = stored(counts.filter(~is_run).select("f", F.col("f").alias("t"), "allow", "block").unionByName(
        counts.join(named, "f").select("f", F.concat(F.lit("h:"), "w").alias("t"), "allow", "block")), "feature-tokens")
    tokens = stored(pieces.groupBy("t").agg(F.sum("allow").alias("allow"), F.sum("block").alias("block")).filter("allow + block > 0"), "tokens")
    size = tokens.agg(F.count(F.lit(1)).alias("n"), F.sum("allow").alias("allow"), F.sum("block").alias("block")).first()
    n = size["n"]
    log_of = {k: F.log((F.col(k) + 1) / F.lit(float((size[k] or 0) + n))) for k in ("allow", "block")}
    odds = tokens.select(F.col("t").alias("token"), F.round((log_of["block"] - log_of["allow"]) * UNIT).cast("long").alias("odds"))
    of_feature = lookup(pieces.select("f", "t"), odds, {"t": "token"}, "odds").groupBy(F.col("f").alias("feature")).agg(
        F.coalesce(F.sum("odds"), F.lit(0)).alias("s"))
    of_url = lookup(found.select("_place", "f", "c"), of_feature, {"f": "feature"}, "feature-odds").groupBy("_place").agg(
        F.sum(F.col("c") * F.col("s")).alias("s"))
    score = F.lit(math.log(bad / good)) + F.coalesce(F.col("s"), F.lit(0)) / UNIT
    return urls.join(of_url, "_place", "left").withColumn("score", score).drop("s")


def judge(pages: DataFrame, rules: list[tuple[str, str]], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, host, path, rule, verdict, score) of every url.

    A url that no rule fits is blocked if its naive Bayes log-odds, in ``score``, are above 0. Null urls, and those without
    ``://``, have empty host and path, and their score is the prior. Repeated rows, and rows with a null key, are rows like any
    other, each judged for itself; a url counts as often as it occurs. An empty table gives no rows; columns but the three named
    are not read. Urls of any length are read whole; null texts have no words.
    """
    host, path = host_and_path(url)
    rule, verdict = ruled(rules)
    urls = pages.select(F.col(key), host.alias("host"), path.alias("path")).withColumn("rule", rule).withColumn("verdict", verdict)
    # Rows are told apart by a number that is stored, as it may differ in another scan.
    urls = stored(urls.withColumn("_place", F.monotonically_increasing_id()), "urls")
    scored = scores(urls, stored(dictionary(pages, html), "dictionary"))
    return scored.withColumn("verdict", F.coalesce("verdict", F.when(F.col("score") > 0, "block").otherwise("allow"))).drop("_place")
