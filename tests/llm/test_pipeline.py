import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
import plain

import corpus_pipeline
from inkloom.llm import quality

SF = "/root/testdata/sf0.001"


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.collect()]


def test_stages_equal_plain_python(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            out.write.parquet(str(tmp_path / str(k)))
            out = spark.read.parquet(str(tmp_path / str(k)))
            kept.append((pairs(docs), pairs(out)))
        else:
            packed = out.collect()
            last = pairs(docs)
        docs = out
    model = quality.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    scores = {r["doc_id"]: r["score"] for r in quality.score_quality(spark.read.parquet(f"{SF}/documents.parquet"), model).collect()}
    assert {i for i, _ in kept[0][1]} == {i for i, s in scores.items() if s >= quality.THRESHOLD} and 0 < len(kept[0][1]) < len(kept[0][0])
    assert sorted(kept[1][1]) == sorted((i, t) for i, t, _, _ in plain.line_dedup(kept[1][0]))
    assert sorted(i for i, _ in kept[2][1]) == sorted(i for i, _, c in plain.components(kept[2][0]) if i == c)
    gone = {i for i, _ in plain.contaminated(kept[3][0], items)}
    assert sorted(i for i, _ in kept[3][1]) == sorted(i for i, _ in kept[3][0] if i not in gone)
    assert {r["doc_id"] for r in packed} == {i for i, _ in last}


def test_stages_on_any_rows(spark):
    """Null, empty and repeated rows, columns with the stages' own names, and an empty table."""
    line = "a line of more than twenty signs that several documents have"
    rows = [(None, line), (1, None), (1, None), (2, ""), (3, f"{line}\nx"), (3, f"{line}\nx"), (4, line), (5, f"{line}\ny"), (6, "word " * 5000), (7, " \n")]
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, row_hash string, carried int, score string, item string, length string"
    for made in (rows, []):
        docs = spark.createDataFrame([(i, t, None, "s", None, "h", 1, "c", "i", "l") for i, t in made], schema)
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, SF)
            assert out.columns == docs.columns, name
            got = out.collect()
            if "Jaccard" in name:  # 3, 4 and 5 are near copies; rows alike are one
                assert sorted(r["doc_id"] for r in got) == ([1, 2, 3, 6, 7] if made else [])
            else:
                assert sorted(r["doc_id"] for r in got) == sorted(i for i, _ in made if i is not None), name
            assert {(r["row_hash"], r["carried"], r["score"], r["item"]) for r in got} <= {("h", 1, "c", "i")}
        packed = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
        assert len({(r["sequence_id"], r["offset"]) for r in packed}) == len(packed) and {r["doc_id"] for r in packed} == {i for i, _ in made if i is not None}
