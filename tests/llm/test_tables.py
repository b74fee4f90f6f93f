"""Results that must not depend on partitioning or on the names of further columns; the pipeline."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from eventgauge.llm import exact_dedup, jaccard_join, quality_rules, suffix_dedup, warc
from eventgauge.llm.shared import table

CLASHING = "doc_id long, text string, _id string, id string, _key int, key int, _text string, cut int, _sha int, sha string, _first int, first int, `a.b` int, n_chars int, row string"


def words(n, seed):
    rng = np.random.default_rng(seed)
    return " ".join("".join(rng.choice(list("abcdefgh"), 6)) for _ in range(n))


def clashing(spark, rows):
    kept = ["i", "d", 1, 2, "t", 3, 4, "s", 5, 6, 7]
    return spark.createDataFrame([(i, t, *kept, None if t is None else len(t), "r") for i, t in rows], CLASHING)


ROWS = [
    (1, words(80, 1)), (2, words(80, 1)), (3, words(80, 1) + " tail"), (4, None), (5, ""), (None, "x y"), (None, None),
    (6, words(60, 2) + " " + words(60, 3)), (7, words(60, 4) + " " + words(60, 3)), (1, words(80, 1)),
]


def same_columns(frame, given):
    assert frame.columns == given.columns and frame.dtypes == given.dtypes
    for r in frame.collect():
        assert (r["_id"], r["id"], r["_key"], r["key"], r["_text"], r["cut"], r["row"]) == ("i", "d", 1, 2, "t", 3, "r")
        assert (r["_sha"], r["sha"], r["_first"], r["first"], r["a.b"]) == (4, "s", 5, 6, 7)
        assert r.n_chars == (None if r.text is None else len(r.text))


def test_further_columns_keep_their_names_and_values(spark):
    given = clashing(spark, ROWS)
    alone = exact_dedup.without_duplicates(given)
    same_columns(alone, given)
    assert sorted((r.doc_id or 0) for r in alone.collect()) == [0, 1, 3, 4, 6, 7]
    far = jaccard_join.one_of_each(given)
    same_columns(far, given)
    assert {r.doc_id for r in far.collect()} >= {1, 6, 7} and 3 not in {r.doc_id for r in far.collect()}
    cut = suffix_dedup.without_repeats(given)
    same_columns(cut, given)
    assert cut.count() == len(ROWS)
    texts = {r.doc_id: r.text for r in cut.collect()}
    assert texts[6].startswith(words(60, 2)[:300]) and words(60, 3) not in texts[6]


def test_rules_do_not_depend_on_partitions(spark):
    documents = table(spark, "/root/testdata/sf0.01", "documents")
    labels = table(spark, "/root/testdata/sf0.01", "labels")
    rules = quality_rules.fitted(documents, labels)
    assert quality_rules.fitted(documents.repartition(7), labels.repartition(3)) == rules
    assert quality_rules.fitted(documents.orderBy(F.desc("doc_id")), labels) == rules


def test_learned_rules_against_a_plain_cover(spark):
    """A planted rule is found, its counts are those of a plain pass, and one class gives no rule."""
    rng = np.random.default_rng(5)
    data = {f: rng.random(3000) for f in quality_rules.FEATURES}
    name = quality_rules.FEATURES[0]
    bad = data[name] > 0.8
    found = quality_rules.learn(data, bad)
    assert found and found[0].conditions[0].feature == name
    left = np.ones(len(bad), bool)
    for rule in found:
        inside = left.copy()
        for c in rule.conditions:
            inside &= (data[c.feature] >= c.threshold) == c.above
        assert rule.covered == inside.sum() and rule.precision == pytest.approx(bad[inside].mean())
        left &= ~inside
    assert not bad[left].mean() > 0.02
    assert quality_rules.learn(data, np.zeros(3000, bool)) == []
    schema = "doc_id long, quality int"
    documents = spark.createDataFrame(ROWS, "doc_id long, text string")
    assert quality_rules.fitted(documents, spark.createDataFrame([(1, None), (None, 0), (2, 1)], schema)) == []


# -- WARC ------------------------------------------------------------------------
def test_archives_are_cut_by_size_and_read_from_files(spark, tmp_path):
    pages = spark.createDataFrame(
        [(i, f"http://a/{i}", words(120, i // 2), "x", 1) for i in range(60)] + [(None, None, None, None, None)],
        "page_id long, url string, html string, archive string, place int",
    )
    written = warc.archives(pages, archive_bytes=4000).collect()
    assert len(written) > 12 and len({r.archive for r in written}) == len(written)
    for r in written:
        (tmp_path / f"{r.archive}.warc.zst").write_bytes(bytes(r.bytes))
    found = {r.page_id: r for r in warc.read_files(spark, f"{tmp_path}/*.warc.zst").collect()}
    assert len(found) == 61 and found[None].record_type == "response"
    for i in range(60):
        twin = i | 1
        assert (found[i].record_type, found[i].refers_to) == (("response", None) if i == twin else ("revisit", twin))
        if i == twin:
            assert bytes(found[i].payload).decode() == words(120, i // 2)
    assert warc.read_files(spark, [f"{tmp_path}/{written[0].archive}.warc.zst"]).count() < 61
    (tmp_path / "bad.warc.zst").write_bytes(bytes(written[0].bytes)[:-3])
    with pytest.raises(Exception, match="ends inside a frame"):
        warc.read_files(spark, f"{tmp_path}/bad.warc.zst").collect()


# -- pipeline --------------------------------------------------------------------
LABELS = "doc_id long, quality int, toxic int"


def pipeline_on(spark, tmp_path, rows):
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], LABELS).write.parquet(f"{folder}/labels.parquet")
    return corpus_pipeline.run(spark, folder).collect()


def test_pipeline_on_awkward_rows(spark, tmp_path):
    passage = words(60, 3)
    found = pipeline_on(spark, tmp_path, ROWS)
    kept = {r.doc_id for r in found}
    # Without labels nobody is toxic; copies, near copies and null texts leave one row each.
    assert {1, 6, 7} <= kept and not kept & {2, 3, 5}
    spans = {}
    for r in found:
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in spans.values():
        ends = [0]
        for offset, length in sorted(pieces):
            assert offset == ends[-1] and length > 0
            ends.append(offset + length)
        assert ends[-1] <= 1024
    assert re.search(r"\w", passage) and len(hashlib.sha256(passage.encode()).hexdigest()) == 64


def test_pipeline_on_an_empty_table(spark, tmp_path):
    assert pipeline_on(spark, tmp_path, []) == []
