"""The pipeline on planted documents, and its registration."""

import random

import corpus_pipeline

import __spark_entry__ as entry
from cdrflow.llm import stages

from .conftest import prose


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names
    for n in range(1, 11):
        assert sum(x.startswith(f"op{n}_") for x in names) == 1
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "line dedup", "minhash near-dedup", "benchmark decontamination", "bpe encoding and decoding"]


def test_planted_documents(spark, make_docs, tmp_dir):
    r = random.Random(12)

    def text(seed):
        return "\n".join(prose(seed * 100 + i, 25) for i in range(4))

    clean = [(d, text(d)) for d in range(300)]
    toxic = [(1000 + d, text(1000 + d).replace(" ", " vile nasty ", 2)) for d in range(80)]
    copies = [(2000 + d, text(d)) for d in range(5)]
    near = []
    for d in range(5, 10):  # one line differs by a word: three lines are the same, the document a near copy
        lines = [x.split() for x in text(d).split("\n")]
        lines[r.randrange(4)][r.randrange(1, 24)] = "otherword"
        near.append((3000 + d, "\n".join(" ".join(x) for x in lines)))
    item = prose(77, 20)
    leaked = [(4000, text(4000) + "\n" + item), (4001, item.upper())]
    passage = prose(88, 60)
    shared = [(5000 + i, text(5000 + i) + "\n" + passage) for i in range(4)]
    docs = make_docs([*clean, *toxic, *copies, *near, *leaked, *shared, (6000, None), (6001, ""), (None, "no id")])
    docs.write.parquet(f"{tmp_dir}/documents.parquet")
    labels = [(d, 1, 0) for d, _ in clean] + [(d, 1, 1) for d, _ in toxic]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_dir}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    rows = corpus_pipeline.run(spark, tmp_dir).collect()
    kept = {x["doc_id"]: x for x in rows}
    assert {d for d, _ in clean} <= set(kept)
    assert not {d for d, _ in toxic + copies + leaked} & set(kept)
    assert {5000, 5001, 5002, 5003, 6000, 6001, None} <= set(kept)
    assert [passage in kept[5000 + i]["text"] for i in range(4)] == [True, False, False, False]
    assert kept[0]["text"] == clean[0][1] and kept[0]["n_tokens"] > 0
    assert not {d for d, _ in near} & set(kept)


def test_line_stage_spares_no_document(spark, make_docs, tmp_dir):
    """Repeated lines go from documents that share over half of another, the rest stays; near copies with words of their own are the next stage's."""
    a, b, c = (prose(i, 14) for i in (21, 22, 23))
    d = "\n".join([c, prose(25, 14), prose(26, 14)])
    long = prose(31, 200)
    rows = [(1, f"{a}\nshort\n{b}"), (2, f"{a}\r\n{b}\nown words"), (3, d), (4, d + "\n" + prose(27, 20)), (5, long), (6, long + "\nthree more words"),
            (7, long + "\n" + prose(32, 60)), (8, "short\n" + prose(33, 30)), (9, f"{a}\n{b}\n \n")]
    got = {x["doc_id"]: x["text"] for x in stages.line_deduped(spark, make_docs(rows), tmp_dir).collect()}
    assert {k: v.strip() for k, v in got.items()} == {
        1: rows[0][1], 2: "own words", 3: d, 4: prose(27, 20), 5: long, 6: rows[5][1], 7: prose(32, 60), 8: prose(33, 30)}


def test_verdicts_are_of_rows(spark, make_docs, tmp_dir):
    """Null and repeated ids: each row by its own text, one row of each group."""
    item = prose(77, 20)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_dir}/benchmark.parquet")
    clean, twice, loose = prose(41, 50), prose(42, 50), prose(43, 50)
    docs = make_docs([(None, item), (None, loose), (None, loose), (1, item), (1, clean), (2, twice), (2, twice), (3, twice)])
    out = stages.decontaminated(spark, docs, tmp_dir).collect()
    assert sorted(x["text"] for x in out) == sorted([loose, loose, clean, twice, twice, twice])
    for stage in (stages.near_dedup, stages.line_deduped):
        out = stage(spark, docs.filter(docs.text != item), tmp_dir).collect()
        assert sorted((x["doc_id"] or 0, x["text"]) for x in out) == sorted([(0, loose), (1, clean), (2, twice)])
