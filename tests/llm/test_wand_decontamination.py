import random

import pytest

from millrace.llm.wand_decontamination import Limits, build_indexes, find_contamination, find_items, match_items, question_and_answer, shingles, words_of


def plain_matches(texts, items, limits):
    """Every item whose question and answer lie in the text, wherever."""
    found = set()
    for at, text in enumerate(texts):
        words = words_of(text)
        for number, (_, item) in enumerate(items):
            question, answer = question_and_answer(item)
            if question:
                wanted = shingles(question, limits.shingle)
                n = min(limits.shingle, len(question))
                asked = len(wanted & (shingles(words, n) if len(words) >= n else set())) / len(wanted)
                if asked >= limits.question_overlap:
                    found.add((at, number))
    return found


@pytest.fixture(scope="module")
def items(spark):
    return [tuple(r) for r in spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet").select("item_id", "text").collect()]


def test_documents_match_brute_force(spark, documents, items):
    texts = [r.text for r in documents.select("text").collect()]
    limits = Limits()
    got = {(at, item) for at, item, *_ in find_items(build_indexes(items, limits), texts, limits)}
    assert got == plain_matches(texts, items, limits) and got


def test_planted_items_are_found_wherever_they_stand(items):
    rng, limits = random.Random(4), Limits()
    index = build_indexes(items, limits)
    filler = [f"filler{i}" for i in range(3000)]
    for number, (_, text) in enumerate(items):
        cut = rng.randrange(3000)
        whole = " ".join(filler[:cut]) + " " + text.upper() + " " + " ".join(filler[cut:])
        assert number in {item for _, item, *_ in find_items(index, ["x", whole, ""], limits)}
    assert not list(find_items(index, [" ".join(filler), "", " "], limits))


def test_question_without_its_answer_is_no_match():
    limits, item = Limits(), "What is the tallest hill in the old county of Mor? It is Ben Alder."
    index = build_indexes([(1, item), (2, "")], limits)
    assert question_and_answer(item)[1] == words_of("It is Ben Alder")
    assert not list(find_items(index, ["What is the tallest hill in the old county of Mor? Nobody can tell."], limits))
    assert len(list(find_items(index, ["Q: what is the tallest hill in the old county of Mor? A: It is Ben Alder!"], limits))) == 1


def test_several_indexes_find_the_same(spark, documents):
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    one = match_items(documents, benchmark)
    many = match_items(documents, benchmark, index_words=300)
    ids = lambda df: {(r.doc_id, x.item) for r in df.collect() for x in r.benchmark_items}
    assert ids(one) == ids(many) and ids(one)


def test_odd_rows(spark, odd_documents, no_documents):
    items = spark.createDataFrame([(1, "Same text here."), (1, "Same text here."), (2, None), (3, ""), (None, "No id, mail a@b.org")], "item_id long, text string")
    got = sorted((str(r.doc_id), str(r.item_id)) for r in find_contamination(odd_documents, items).collect())
    assert got == [("4", "1"), ("4", "1"), ("5", "1"), ("None", "None")]
    assert find_contamination(no_documents, items).count() == 0
    assert find_contamination(odd_documents, items.limit(0)).count() == 0
    assert match_items(odd_documents.withColumnRenamed("labels", "benchmark_items"), items).columns.count("benchmark_items") == 1
