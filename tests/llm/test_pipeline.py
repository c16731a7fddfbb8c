import corpus_pipeline
from tests.llm.test_dedup import components
from tests.llm.test_scans import contaminated

SF = "/root/testdata/sf0.001"


def test_pipeline_stage_by_stage(spark):
    """Each stage keeps exactly the rows that its plain version keeps of its input."""
    from windrose.llm import quality
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    state = {r.doc_id: r.text for r in docs.collect()}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = stage(spark, docs, SF).cache()
        assert got.columns == columns
        kept = {r.doc_id: r.text for r in got.collect()}
        assert kept.items() <= state.items()
        if name == "quality":
            score = {r.doc_id: r.score for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
            want = {i for i in state if score[i] >= 0.5}
        elif name == "exact_dedup":
            last = {}
            for i in sorted(state):
                last[state[i]] = i
            want = set(last.values())
        elif name == "near_dedup":
            want = {i for i, _, c in components(list(state), list(state.values())) if i == c}
        else:
            want = {i for i, t in state.items() if not list(contaminated([t], items))[0][4]}
        assert set(kept) == want, name
        docs, state = got, kept
    final = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {r.doc_id for r in final} == set(state)
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted(whole) == sorted(final)


def test_stages_name_the_operators():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "exact_dedup", "near_dedup", "decontaminate", "byte_bpe"]


def _tables(folder, docs, labelled):
    spark = docs.sparkSession
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in labelled], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([(1, "ONE, two!"), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return str(folder)


def test_edge_rows_go_through_the_whole_pipeline(spark, edge, edge_rows, tmp_path):
    """Null and repeated ids, null, empty and very long texts, copies and columns whose names the operators use."""
    sf = _tables(tmp_path / "edge", edge, [i for i in edge_rows[0] if i is not None])
    by_text = {}
    for i, t in zip(*edge_rows):         # all labels are good, so quality keeps every row
        by_text.setdefault(t or "", []).append(i)
    # of equal texts the largest doc_id stays, rows without one only if there is no other
    left = [(max((i for i in ids if i is not None), default=None), t) for t, ids in by_text.items()]
    near = components([i for i, _ in left], [t for _, t in left])
    stays = [(i, t) for i, t in left if (i, i) in {(a, c) for a, _, c in near if a == i}]
    want = sorted(str(i) for i, t in stays if not list(contaminated([t], [(1, "ONE, two!")]))[0][4])
    assert sorted(str(r.doc_id) for r in corpus_pipeline.run(spark, sf).collect()) == want


def test_an_empty_table_goes_through_the_whole_pipeline(spark, nothing, tmp_path):
    assert corpus_pipeline.run(spark, _tables(tmp_path / "none", nothing, [])).count() == 0
