import __spark_entry__ as entry_point
import corpus_pipeline
from conftest import SF_DIR
from test_line_dedup import brute_force as lines_to_remove
from test_near_dedup import brute_force as groups
from test_decontaminate import substring_distance
from tickbars.llm.decontaminate import plain
from tickbars.llm.line_dedup import LineDedup
from pyspark.sql import functions as F

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("doc_id < 60")
    bench = spark.read.parquet(f"{SF_DIR}/benchmark.parquet")
    quote = bench.first().text
    text = docs.where("length(text) > 800").first().text
    near = text.replace(".", " extra .", 1)
    odd = [(9001, text, "en", "s", 1), (9002, near, None, None, None), (9003, "12345 !!", "en", "s", 8), (9004, None, None, None, None),
           (9005, "Quite another line of words, and then: " + quote.upper(), "en", "s", 1), (None, "The id of this text is not known to us", "en", "s", 1)]
    docs.union(spark.createDataFrame(odd, docs.schema)).write.parquet(f"{tmp_path}/documents.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")

    before, frames = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for _, stage in corpus_pipeline.STAGES:
        path = f"{tmp_path}/stage-{len(frames)}"
        stage(spark, before, str(tmp_path)).write.parquet(path)
        made = spark.read.parquet(path)
        frames.append((before.withColumn("h", F.xxhash64("text")).collect(), made.collect(), made.columns))
        before = made
    assert all(columns == COLUMNS for *_, columns in frames[:-1])

    given, left, _ = frames[0]
    assert {r.doc_id for r in given} - {r.doc_id for r in left} == {9003, 9004}

    given, left, _ = frames[1]
    gone, want = lines_to_remove([(r.doc_id, r.h, r.text) for r in given], LineDedup()), []
    for r in given:
        lines = r.text.split("\n")
        mine = [x for k, x in enumerate(lines) if (-(2**63) if r.doc_id is None else r.doc_id, r.h, k) not in gone]
        if len(mine) == len(lines) or "".join(mine).strip():
            want.append((r.doc_id, "\n".join(mine)))
    assert sorted(((r.doc_id, r.text) for r in left), key=repr) == sorted(want, key=repr)

    given, left, _ = frames[2]
    smallest = groups([(r.doc_id, r.text) for r in given], 5, 80)
    assert {r.doc_id for r in left} == {i for i, (_, c) in smallest.items() if i == c} | {None}

    given, left, _ = frames[3]
    items = [plain(r.text) for r in bench.collect()]
    dirty = {r.doc_id for r in given if any(i in plain(r.text) for i in items)}
    assert {r.doc_id for r in left} == {r.doc_id for r in given} - dirty and 9005 in dirty
    for r in left[:2]:
        assert all(substring_distance(i, plain(r.text)[:3000]) > len(i) // 15 for i in items[:5])

    given, left, _ = frames[4]
    assert sorted(repr(r.doc_id) for r in left) == sorted(repr(r.doc_id) for r in given) and all(r.intact for r in left)


def test_run_chains_the_stages_and_leaves_one_table(spark, tmp_path, monkeypatch):
    rows = [(i, f"Document {i} has some words of its own {i * 7} and ends.", "en", "s", 1) for i in range(4)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{tmp_path}/documents.parquet")
    seen = []

    def stage(name):
        def go(spark, docs, sf_dir):
            seen.append((name, docs.count()))
            return docs.where(F.col("doc_id") != len(seen))

        return name, go

    monkeypatch.setattr(corpus_pipeline, "STAGES", [stage("a"), stage("b"), stage("c")])
    monkeypatch.setattr(corpus_pipeline, "scratch_dir", lambda spark, label: f"{tmp_path}/scratch/{label}")
    assert [r.doc_id for r in corpus_pipeline.run(spark, str(tmp_path)).collect()] == [0]
    assert seen == [("a", 4), ("b", 3), ("c", 2)] and [p.name for p in (tmp_path / "scratch").iterdir()] == ["pipeline-c"]


def odd_documents(spark):
    """Repeated and null ids, copies, null and wordless texts, and columns with names that the operators use."""
    a, b = (" ".join(f"{c}word{i}" for i in range(30)) for c in "xy")
    rows = [(3, a), (5, a), (5, b), (5, b), (6, None), (7, "..."), (7, "..."), (8, ""), (None, a), (2**62, b.replace("yword29", "other"))]
    names = "score int, rejected string, lang_pred string, kept string, n_removed int, n_lines int, key string, text_hash int, ids string, id int, h int"
    made = [(i, t, None, "s", 1, k, str(k), str(k), str(k), k, k, str(k), k, str(k), k, k) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(made, f"{DOCUMENTS}, {names}")


def test_near_dedup_decides_row_by_row_whatever_the_names(spark):
    docs = odd_documents(spark)
    made = corpus_pipeline.near_dedup(spark, docs, "")
    assert made.columns == docs.columns
    kept = sorted(((r.doc_id, r.text and r.text[:6]) for r in made.collect()), key=repr)
    # (5, b) was lost once because (5, a) is a copy of document 3.
    assert kept == sorted([(3, "xword0"), (5, "yword0"), (6, None), (7, "..."), (8, ""), (None, "xword0")], key=repr)


def test_language_and_line_dedup_whatever_the_names(spark):
    docs = odd_documents(spark)
    spoken = corpus_pipeline.language(spark, docs, "")
    assert spoken.columns == docs.columns and spoken.count() == 6
    labelled = docs.withColumn("lang", F.lit("xx"))
    assert corpus_pipeline.language(spark, labelled, "").columns == docs.columns
    lines = corpus_pipeline.line_dedup(spark, docs, "")
    assert lines.columns == docs.columns
    # Of the lines that two documents share, the earliest place stays: that without an id.
    assert sorted({repr(r.doc_id) for r in lines.collect()}) == sorted(map(repr, {5, 6, 7, 8, None}))


def test_empty_table_passes_all_stages(spark, tmp_path):
    docs = spark.createDataFrame([], DOCUMENTS)
    spark.createDataFrame([(1, "some item of the benchmark, quite long")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES:
        made = stage(spark, docs, str(tmp_path))
        assert made.count() == 0


def test_every_operator_has_a_query():
    names = set(entry_point.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{k}" for k in range(1, 14)} and "pipeline" in names
