from campanula.llm import decontaminate as D


def test_blocks_are_bounded_and_made_one_at_a_time(spark):
    bench = spark.createDataFrame([(i, f"word{i} and more text") for i in range(50)] + [(99, "long " * 400)], "item_id long, text string")
    blocks = D._blocks(bench, "item_id", "text", 10, 1000)
    assert not isinstance(blocks, (list, tuple))
    sizes = [(len(b), sum(len(t) * 10 for _, t in b)) for b in blocks]
    assert sum(n for n, _ in sizes) == 51 and all(size <= 1000 or n == 1 for n, size in sizes)


def test_released_blocks_leave_whole_results(spark):
    docs = spark.createDataFrame([(i, f"x word{i} and more text y", i) for i in range(40)] + [(77, None, 0), (78, "nothing", 0)],
                                 "doc_id long, text string, __more long")
    bench = spark.createDataFrame([(i, f"word{i} and more text") for i in range(0, 40, 2)], "item_id long, text string")
    out = D.contamination_digest(docs, bench.repartition(3), window=10)
    many = D.find_contamination(docs.drop("__more"), bench, block_chars=800)
    assert {r.doc_id for r in out.where("contaminated").collect()} == set(range(0, 40, 2))
    got = {r.doc_id: r.contamination for r in many.collect()}
    assert {d for d, c in got.items() if c.runs} == set(range(0, 40, 2)) and got[77].n_words == 0 and len(got) == 42
    assert many.count() == 42  # read again: nothing that is needed has been released


def test_empty_benchmark_and_benchmark_without_words(spark):
    docs = spark.createDataFrame([(1, "some text")], "doc_id long, text string")
    for bench in ([], [(1, "..."), (2, None), (None, "")]):
        b = spark.createDataFrame(bench, "item_id long, text string")
        assert D.contamination_digest(docs, b).first().n_words == 2 and D.drop_contaminated(docs, b).count() == 1
