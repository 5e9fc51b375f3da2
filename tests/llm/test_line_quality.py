import re
from collections import Counter

from millrace.llm.line_quality import LineRules, clean_lines

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    count, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        if count[w] > 1:
            covered |= {i, i + 1, i + 2}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def test_counts_match_plain_version(documents, odd_documents):
    for docs in (documents.select("doc_id", "text"), odd_documents):
        for r in clean_lines(docs).collect():
            want = plain(r["text"])
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
            assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
            assert not (r.base_failed and r.kept)


def test_clashing_columns_and_empty_table(odd_documents, no_documents):
    out = clean_lines(odd_documents)
    assert out.columns.count("n_words") == 1 and "labels" in out.columns and out.count() == 12
    assert clean_lines(no_documents).count() == 0


def test_lines_are_judged_one_by_one(spark):
    clean = "This sentence is long enough to be kept, and it says something of its own number {}."
    lines = [
        (clean.format(1), True), ("Home | Products | About us | Contact", False), ("Subscribe to our newsletter", False),
        ("*** ### $$$ %%%", False), ("--- . ---", False), ("Menu", False), ("Why not?", True), ("", True),
        ("This site uses cookies.", False), ("The long story goes on with no full stop but enough words", True),
    ]
    rows = [(i, line) for i, (line, _) in enumerate(lines)]
    out = clean_lines(spark.createDataFrame(rows, "doc_id long, text string"), rules=LineRules(fewest_words=0, most_lost_percent=100))
    kept = {r.doc_id: r.n_lines_removed == 0 for r in out.collect()}
    assert kept == {i: ok for i, (_, ok) in enumerate(lines)}


def test_documents_that_lose_too_much_go(spark):
    good = "\n".join(f"Sentence number {i} of the story tells what happened on day {i} of the journey." for i in range(20))
    bad = "\n".join("Home | News | Sport | Weather | Shop | Contact" for _ in range(20)) + "\n" + "\n".join(
        f"Sentence number {i} is fine." for i in range(10))
    mixed = good + "\nSubscribe to our newsletter"
    rows = spark.createDataFrame([(1, good), (2, bad), (3, mixed)], "doc_id long, text string")
    found = {r.doc_id: r for r in clean_lines(rows, rules=LineRules(most_repeat_percent=100)).collect()}
    assert found[1].kept and found[1].cleaned_text == good
    assert not found[2].kept and not found[2].base_failed and found[2].n_lines_removed == 20
    assert found[3].kept and found[3].cleaned_text == good and found[3].chars_removed == 27


def test_filters_do_not_repeat_the_work(documents):
    found = clean_lines(documents).filter("kept")
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Filter") < plan.index("Generate") and found.count() >= 0
