"""Every operator on nulls, empty and very long texts, ties, repeated rows, empty tables and clashing columns."""

import itertools
import random
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from lumetry.llm import (
    cover_tree,
    decontamination,
    fixity,
    licenses,
    near_duplicates,
    packing,
    quality,
    sharding,
    substrings,
    token_files,
)
from lumetry.llm.common import digest

from .conftest import prose


def ids(frame):
    return Counter(r["doc_id"] for r in frame.select("doc_id").collect())


def test_packing(awkward, nothing):
    rows = packing.pack(awkward).collect()
    by_id = Counter()
    for r in rows:
        by_id[r["doc_id"]] += r["length"]
        assert len(r["ids"]) == r["length"]
    assert by_id[4] == by_id[5] == 1 and by_id[None] > 80
    assert sum(r["length"] for r in rows if r["doc_id"] == 9) == 2 * next(r["doc_tokens"] for r in rows if r["doc_id"] == 9)
    sizes = Counter()
    for r in rows:
        sizes[r["sequence_id"]] += r["length"]
    assert all(n == 1024 or n & (n - 1) == 0 for n in sizes.values())
    assert packing.pack(nothing).count() == 0


def test_token_files(spark, awkward, nothing, tmp_path):
    token_files.write_tokens(awkward, f"{tmp_path}/some")
    rows = sorted(token_files.document_digests(spark, f"{tmp_path}/some").collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None, None, 1, 2, 3, 4, 5, 6, 7, 8, 9, 9, 10]
    at = 0
    for r in rows:
        assert r["start"] == at
        at += r["n_tokens"]
    token_files.write_tokens(nothing, f"{tmp_path}/none")
    assert token_files.document_digests(spark, f"{tmp_path}/none").count() == 0


def test_near_duplicates(awkward, nothing):
    rows = near_duplicates.near_duplicates(awkward).collect()
    found = {r["doc_id"]: (r["class_id"], r["group_id"]) for r in rows}
    assert found == {
        1: (1, 1), 2: (1, 1), 3: (3, 1), 4: (4, 4), 5: (4, 4), 6: (6, 6), 7: (7, 7), 8: (8, 8), 9: (9, 9), 10: (10, 10),
    }
    assert len(rows) == 11
    assert near_duplicates.near_duplicates(nothing).count() == 0


def test_quality(spark, awkward, nothing):
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1), (None, 1), (6, None), (7, 5), (8, 0)], "doc_id LONG, quality INT")
    model = quality.learn(awkward, labels)
    scores = quality.scores(awkward, model).collect()
    assert len(scores) == 13 and all(0 <= r["score"] <= 1 for r in scores)
    kept = quality.accepted(awkward, model, 0.0)
    assert kept.columns == awkward.columns and ids(kept) == ids(awkward)
    nobody = quality.learn(nothing, labels.limit(0))
    assert {r["score"] for r in quality.scores(awkward, nobody).collect()} == {0.5}
    assert quality.scores(nothing, model).count() == quality.accepted(nothing, model, 0.3).count() == 0


def test_substrings(awkward, nothing):
    done = substrings.deduplicated(awkward)
    rows = done.collect()
    assert done.columns == [*awkward.columns, substrings.REMOVED, substrings.SPANS]
    text = {r["doc_id"]: r["text"] for r in rows if r["doc_id"] not in (9, None)}
    assert len(rows) == 13 and text[1] == prose(1, 120) and text[2] == "" and text[4] is None and text[5] == ""
    assert text[3].strip() == "end" and text[7] == "short"
    assert [r["text"] for r in rows if r["doc_id"] == 9] == [prose(4, 70)] * 2  # rows that repeat id and text are one text
    assert substrings.deduplicated(nothing).count() == 0


def test_decontamination(spark, awkward, nothing):
    bench = spark.createDataFrame([(1, prose(1, 15)), (2, "short"), (3, None), (None, prose(4, 12)), (3, "")], "item_id LONG, text STRING")
    found = {r["doc_id"]: r for r in decontamination.occurrences(awkward, bench).collect()}
    assert found[1]["n_hit"] == 15 and found[1]["items"] == ["1"] and found[7]["items"] == ["2"]
    assert found[9]["n_hit"] == 12 and found[9]["items"] == [] and found[4]["n_words"] == 0
    clean = decontamination.decontaminated(awkward, bench)
    assert clean.columns == awkward.columns
    assert ids(clean) == ids(awkward) - Counter([7])
    assert decontamination.occurrences(nothing, bench).count() == decontamination.decontaminated(nothing, bench).count() == 0
    assert ids(decontamination.decontaminated(awkward, bench.limit(0))) == ids(awkward)


INTERNAL = ["__id", "__digest", "__ends", "removed_words", "removed_spans", "id", "tie", "ends", "digest_", "prints", "size", "place",
            "_id", "text_", "label", "word", "share", "bucket", "weight", "lane", "prefix", "wanted", "runs", "collapsed"]


def test_pipeline_stages(spark, awkward, nothing, tmp_path):
    """Every stage on rows with nulls, repeats and columns of all internal names, and on an empty table."""
    labels = [(1, 1, 0), (2, 0, 0), (3, 1, 0), (None, 1, 0), (7, 0, 0), (8, 0, 0)]
    spark.createDataFrame(labels, "doc_id LONG, quality INT, toxic INT").write.parquet(f"{tmp_path}/labels.parquet")
    items = spark.createDataFrame([("a", prose(1, 15)), ("b", None), (None, "")], "item_id STRING, text STRING")
    items.write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = awkward.withColumn("n_chars", F.length("text").cast("long")).withColumns({n: F.lit("x") for n in INTERNAL})
    for name, stage in corpus_pipeline.STAGES[:-1]:
        some, none = (stage(spark, d, str(tmp_path)) for d in (docs, docs.limit(0)))
        assert some.columns == none.columns == docs.columns, name
        rows = some.collect()
        assert none.count() == 0 and rows and not ids(some) - ids(docs), name
        assert all(r[n] == "x" for r in rows for n in INTERNAL)
        assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in rows), name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, docs, str(tmp_path)).count() > 13 and last(spark, docs.limit(0), str(tmp_path)).count() == 0


def test_learning_takes_one_row_for_each_label(spark):
    """A doc_id that many texts share does not fill the one task that learns."""
    rows = [(i, prose(i, 30)) for i in range(40)] + [(3, prose(k, 25)) for k in range(500)] + [(3, None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(7)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id LONG, quality INT")
    model, other = quality.learn(docs, labels), quality.learn(docs.repartition(2), labels)
    assert (model[0] == other[0]).all() and model[1] == other[1]


def test_sharding(awkward, nothing):
    rows = sharding.shards(awkward, 1000).collect()
    assert Counter(r["doc_id"] for r in rows) == ids(awkward)
    sizes, members = Counter(), Counter()
    for r in rows:
        sizes[r["shard"], r["page"]] += r["n_bytes"]
        members[r["shard"], r["page"]] += 1
    assert all(n <= 1000 or members[at] == 1 for at, n in sizes.items())
    assert sharding.shards(nothing).count() == 0


def test_licenses(spark, awkward, nothing):
    assert licenses.scan(awkward).count() == licenses.scan(nothing).count() == 0
    text = "x y z\nReleased under the  MIT license. " + prose(1, 50)
    docs = spark.createDataFrame([(1, text), (1, text), (None, "Licensed under CC BY-NC 4.0.")], "doc_id LONG, text STRING")
    found = [(r["doc_id"], r["license"], r["containment"]) for r in licenses.scan(docs).collect()]
    assert sorted(found, key=str) == [(1, "MIT", 1.0)] * 2 + [(None, "CC-BY-NC-4.0", 1.0)]
    assert licenses.scan(docs, [("none", "two words")]).count() == 0


def test_embeddings(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [1.0, 0.01]), (4, [0.0, 0.0]), (5, None), (6, [nan, 1.0]), (7, [inf, 1.0]),
        (8, [None, 1.0]), (9, [0.0, 1.0]), (None, [1.0, 0.0]), (10, [1.0, 0.0, 0.0]), (11, [0.0, 1.0]), (12, [1e-300, 0.0]), (13, []),
    ]
    vectors = spark.createDataFrame([(*r, 0) for r in rows], "vec_id LONG, embedding ARRAY<DOUBLE>, component LONG")
    found = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in cover_tree.near_duplicates(vectors).collect()}
    alone = {i: (0, i, True) for i in (4, 5, 6, 7, 8, 10, 13)}
    linked = {1: (3, 1, True), 2: (3, 1, False), 3: (3, 1, False), 12: (3, 1, False), 9: (1, 9, True), 11: (1, 9, False)}
    assert found == alone | linked
    assert cover_tree.near_duplicates(vectors.limit(0)).count() == 0


def test_fixity(spark):
    rows = [(i, f"http://x/{i}", "y" * (i % 700)) for i in range(3000)] + [(None, None, None), (5, "http://x/5", "yyyyy")]
    pages = spark.createDataFrame(rows, "page_id LONG, url STRING, html STRING")
    ours = fixity.records(pages, 1000)
    assert fixity.audit(ours, ours).count() == 0
    theirs = ours.where("record_id <> 2999").selectExpr(
        "file", "record_id", "offset", "length", "if(record_id IN (7, 1500), 'bad', digest) AS digest"
    )
    found = {(r["file"], r["record_id"], r["status"]) for r in fixity.audit(ours, theirs.union(ours.where("record_id IS NULL"))).collect()}
    assert found == {(0, 7, "corrupt"), (1, 1500, "corrupt"), (2, 2999, "missing")}
    assert fixity.audit(ours.limit(0), ours.limit(0)).count() == 0


def test_near_duplicates_in_large_buckets(spark):
    """Pairs of similarity 0.82 in families that share a template: each bucket holds many, but no two families are alike."""
    chance = random.Random(4)
    texts = {}
    for family in range(40):
        base = [f"w{i}" for i in range(400)]
        slots = chance.sample(range(2, 400, 5), 12)
        for slot in slots[:4]:
            base[slot] = f"family{family}x{slot}"
        for member in range(2):
            own = list(base)
            for slot in slots[4 + 4 * member : 8 + 4 * member]:
                own[slot] = f"member{family}x{member}x{slot}"
            texts[2 * family + member] = " ".join(own)
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, w in ((i, t.split()) for i, t in texts.items())}
    for i, j in itertools.combinations(sets, 2):
        both = len(sets[i] & sets[j])
        assert (both >= 0.8 * (len(sets[i]) + len(sets[j]) - both)) == (i // 2 == j // 2)
    docs = spark.createDataFrame(list(texts.items()), "doc_id LONG, text STRING")
    found = near_duplicates.near_duplicates(docs, bucket=5).collect()
    assert {r["doc_id"]: r["group_id"] for r in found} == {i: i // 2 * 2 for i in texts}


def test_estimates_pass_over_no_pair():
    deviation = (0.8 * 0.2 / near_duplicates.COORDINATES) ** 0.5
    assert 0.8 - near_duplicates.least_estimate(0.8) > 5.9 * deviation


def test_near_duplicates_with_two_texts_of_one_id(spark):
    rows = [(3, prose(1, 120)), (5, prose(1, 119) + " end"), (5, prose(2, 90)), (8, prose(2, 89) + " other"), (9, prose(6, 40))]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING")
    digests = {bytes(r["digest"]): r["text"] for r in docs.select(digest("text").alias("digest"), "text").collect()}
    found = {(r["doc_id"], digests[bytes(r["digest"])]): r["group_id"] for r in near_duplicates.near_duplicates(docs).collect()}
    assert found == dict(zip(rows, (3, 3, 5, 5, 9)))


def test_decontamination_in_several_blocks(spark, monkeypatch):
    """Rows as with one block, also where they repeat a doc_id or have none, and where a cut brings another phrase together."""
    items = [(str(i), prose(20 + i, 10)) for i in range(6)]
    texts = [prose(1, 30), prose(2, 5) + " " + items[0][1] + " " + prose(3, 8), items[1][1] + " " + items[2][1]]
    for _, outer in items[3:]:
        for _, inner in items[3:]:
            w = outer.split()
            texts.append(" ".join(["left", *w[:5], inner, *w[5:], "right"]))
    rows = [(i, t) for i in (1, 1, None) for t in texts] + [(2, None)]
    docs = spark.createDataFrame(rows, "doc_id LONG, text STRING").repartition(3)
    bench = spark.createDataFrame(items, "item_id STRING, text STRING")

    def results():
        found = decontamination.occurrences(docs, bench).collect()
        clean = decontamination.decontaminated(docs, bench).collect()
        plain = [(r["doc_id"], r["n_words"], r["n_hit"], sorted(r["items"]), [tuple(s) for s in r["spans"]]) for r in found]
        return Counter(map(str, plain)), Counter((r["doc_id"], " ".join((r["text"] or "").split())) for r in clean)

    one = results()
    monkeypatch.setattr(decontamination, "PHRASE_BYTES", 100)
    assert results() == one and sum(one[0].values()) == len(rows)
