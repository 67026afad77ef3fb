"""The stages of the pipeline, one after the other, and their decisions."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelwright.llm import common, lines, multiset, queries, simhash, suffixes, surrogates, warc
from tests.compare import connect, differences
from tests.llm.test_duplicates import simple_print, simple_removed


def stages(spark, docs, sf, folder):
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        path = f"{folder}/{name.replace(' ', '-')}"
        stage(spark, out[-1], sf).write.parquet(path)
        out.append(spark.read.parquet(path))
    return out


def test_pipeline(spark, sf, tmp_path):
    common.importable(spark)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    start, quality, single, cut, private, packed = stages(spark, docs, sf, tmp_path)
    assert all(d.columns == docs.columns for d in (quality, single, cut, private))
    assert all(d.filter("n_chars <> length(text)").isEmpty() for d in (quality, cut, private))
    kept = {r.doc_id for r in lines.rules(start).filter("kept").collect()}
    assert {r.doc_id for r in quality.collect()} == kept
    rows = [(r.doc_id, simple_print(r.text)) for r in quality.collect()]
    left = {r.doc_id for r in single.collect()}
    for a, x in rows:
        assert a in left or any(b < a and (x ^ y).bit_count() <= 4 or b in left for b, y in rows if a != b)
    assert not any((x ^ y).bit_count() <= 4 for a, x in rows for b, y in rows if a < b and a in left and b in left)
    gone = simple_removed([(r.doc_id, r.text) for r in single.collect()], corpus_pipeline.REPEAT_BYTES)
    texts = {r.doc_id: r.text for r in cut.collect()}
    for line in gone:
        doc, n, removed, spans, _ = eval(line)  # noqa: S307
        assert n - removed - 4 * 2 * spans <= len(texts[doc].encode()) <= n - removed
    assert private.count() == cut.count() and {r.doc_id for r in packed.collect()} == left


def test_pipeline_at_the_edges(spark, sf, edge_docs, no_docs, tmp_path):
    out = stages(spark, edge_docs, sf, f"{tmp_path}/edge")
    assert all(d.columns == edge_docs.columns for d in out[1:-1])
    assert [d.count() for d in stages(spark, no_docs, sf, f"{tmp_path}/none")] == [0] * 6


@pytest.mark.parametrize("name", ["rules", "first", "repeats", "surrogates", "warc"])
def test_rows_keep_their_places_when_splits_change(spark, tmp_path, monkeypatch, name):
    shared = " ".join(f"passage{k} of both" for k in range(40))
    prose = [" ".join(f"{chr(97 + k)}{chr(97 + j % 26)}{j // 26}{'x' * (k % 5)}" for j in range(70)) for k in range(16)]
    ips = [f"at 10.0.{k}.{j} now" for k in range(16) for j in (1,)]
    rows = [(k, f"{p}\n{ip}\nMr. Abel{chr(97 + k)}" + (f" {shared}" if k in (3, 12) else "")) for k, (p, ip) in enumerate(zip(prose, ips))]
    for k, row in enumerate(rows):
        spark.createDataFrame([(*row, "a", "http://a")], "doc_id long, text string, source string, url string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    real, turn = suffixes.stored, iter(range(10_000))

    def shifted(frame, label):
        out = real(frame, label)
        spark.conf.set("spark.sql.files.minPartitionNum", str([16, 1, 3][next(turn) % 3]))
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        return out

    for module in (lines, simhash, suffixes, surrogates, warc):
        monkeypatch.setattr(module, "stored", shifted)
    # All surrogates of the first draw count as taken, so that each document is looked up by its place.
    monkeypatch.setattr(surrogates, "settled", lambda entities, key: entities.select("kind", "canon", F.lit(1).alias("attempt")))
    run = {
        "rules": lambda d: lines.clean(d), "first": lambda d: simhash.first_of_each(d), "repeats": lambda d: suffixes.without_repeats(d, 200),
        "surrogates": lambda d: surrogates.replace(d, "key"), "warc": lambda d: warc.round_trip(d.unionByName(d), "doc_id", "url", "text"),
    }[name]
    spark.conf.set("spark.sql.files.minPartitionNum", "1")
    try:
        found = sorted(str(tuple(r)) for r in run(docs).collect())
        monkeypatch.undo()
        if name == "surrogates":
            monkeypatch.setattr(surrogates, "settled", lambda entities, key: entities.select("kind", "canon", F.lit(1).alias("attempt")))
        assert found == sorted(str(tuple(r)) for r in run(docs).collect())
        assert len(found) == (32 if name == "warc" else 16)
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_multisets_keep_their_rows_when_splits_change(spark, tmp_path, monkeypatch):
    for k in range(16):
        rows = [(None if k == 5 else k * 9 + j // 2, f"text {k} {j % 3}\nmore of it, {j}", "a") for j in range(18)]
        spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/d")
    docs = spark.read.parquet(f"{tmp_path}/d")
    monkeypatch.setattr(multiset, "BUCKET_ROWS", 7)
    try:
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        spark.conf.set("spark.sql.files.minPartitionNum", "1")
        found = multiset.compare_with_next(docs)
        spark.conf.set("spark.sql.files.minPartitionNum", "16")
        found = sorted(str(tuple(r)) for r in found.collect())
    finally:
        spark.conf.unset("spark.sql.files.minPartitionNum")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(found) == 288
    monkeypatch.setattr(multiset, "BUCKET_ROWS", 2_000)
    assert found == sorted(str(tuple(r)) for r in multiset.compare_with_next(docs).collect())
    with pytest.raises(ValueError, match="no number"):
        multiset.compare_with_next(docs.withColumn("doc_id", F.col("text")))


def test_quality_sql_counts_true_documents(spark, tmp_path):
    """A menu of many lines on some of a host's documents: the line of the least hash says nothing about how many there are."""
    menu = "\n".join(f"menu entry {chr(97 + k)} of the house" for k in range(15))
    own = [" ".join(f"w{chr(97 + k % 26)}{chr(97 + k // 26)}{chr(97 + j % 26)}{'y' * (j // 26)}" for j in range(80)) for k in range(200)]
    rows = [(k, f"{menu}\n{text}" if k % 8 == 0 else text, "en", "h", 1) for k, text in enumerate(own)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").coalesce(1).write.parquet(f"{tmp_path}/all")
    part = next(tmp_path.glob("all/*.parquet"))
    part.rename(tmp_path / "documents.parquet")
    found = queries.QUERIES["op6_quality"](spark, str(tmp_path))
    assert found.filter("words_left < n_words").count() == 25
    assert differences(found, connect(str(tmp_path)), queries.ORACLES["op6_quality"]) == ""
