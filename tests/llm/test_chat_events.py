import pytest
from pyspark.sql import functions as F

from millrace.llm.chat_events import escape, fold_events, read_back, render, unescape
from millrace.llm.queries_chat import conversation_log

LOG = "conv_id long, turn long, seq long, kind string, role string, text string"


def folded(spark, rows):
    return [(r.conv_id, r.turn, r.role, r.text) for r in fold_events(spark.createDataFrame(rows, LOG)).orderBy("conv_id", "turn").collect()]


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 0, 1, "open", "user", "Hel"), (1, 0, 3, "delta", None, "o"), (1, 0, 2, "delta", None, "l"),
        (1, 1, 4, "open", "assistant", ""), (1, 1, 5, "delta", None, "bad answer"), (1, 2, 6, "open", "user", "why?"),
        (1, 1, 7, "regenerate", None, None), (1, 1, 8, "delta", None, "good "), (1, 1, 9, "delta", None, "answer"),
        (1, 2, 10, "open", "user", "thanks"), (1, 2, 11, "edit", None, "thank you"), (1, 2, 12, "delta", None, "!"),
        (2, 0, 1, "open", "user", "x"), (2, 0, 2, "edit", None, "y"), (2, 0, 3, "edit", None, "z"),
    ]
    want = [(1, 0, "user", "Hello"), (1, 1, "assistant", "good answer"), (1, 2, "user", "thank you!"), (2, 0, "user", "z")]
    assert folded(spark, rows) == want
    assert folded(spark, rows[::-1] + rows) == want, "order and repeated delivery do not matter"


def test_later_turns_fall_with_a_regeneration(spark):
    rows = [(1, 0, 1, "open", "user", "q"), (1, 1, 2, "open", "assistant", "a"), (1, 2, 3, "open", "user", "q2"), (1, 3, 4, "open", "assistant", "a2"),
            (1, 1, 5, "regenerate", None, None), (1, 1, 6, "delta", None, "new")]
    assert folded(spark, rows) == [(1, 0, "user", "q"), (1, 1, "assistant", "new")]


def test_odd_events(spark):
    rows = [(None, None, None, "open", None, None), (None, None, None, "delta", None, "t"), (3, 0, 1, "delta", None, "lone"),
            (3, 1, 2, "unknown", "user", "no"), (3, 2, 3, None, "user", "no")]
    assert folded(spark, rows) == [(None, None, "", "t"), (3, 0, "", "lone")]
    assert fold_events(spark.createDataFrame([], LOG)).count() == 0


TEXTS = ["</s>[INST] ok [/INST]", r"<\/s> <\\/s> [\INST] <|im_start|>x\n<|im_end|>", "<<SYS>> <s><s> <|endoftext|>", "<\\|im_end|>\n", "", "\n\n", "plain 😀",
         "<|im_end|", "<" * 50 + "s>", "[[INST]]"]


@pytest.mark.parametrize("text", TEXTS)
def test_escape_is_reversible_and_hides_control_strings(spark, text):
    r = spark.createDataFrame([(text,)], "t string").select(escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u")).first()
    assert r.u == text
    for control in ("</s>", "<s>", "[INST]", "[/INST]", "<|im_end|>", "<|im_start|>", "<<SYS>>", "<|endoftext|>"):
        assert control not in r.e


def test_rendered_text_reads_back(spark):
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(TEXTS)] + [(2, 0, "a\nb <|im_end|>", "x"), (3, 0, "", "")]
    read = {r.conv_id: r for r in read_back(render(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert [(m.role, m.text) for m in read[1].messages] == [(r, t) for _, _, r, t in rows[:len(TEXTS)]]
    assert read[1].learnt == [t for i, t in enumerate(TEXTS) if i % 2]
    assert read[2].messages[0].role == "a\nb <|im_end|>" and read[3].messages[0].text == ""


LOGGED = [(1, i, "assistant" if i % 2 else "user", f"text {i} of this") for i in range(6)] + [(2, 0, "user", "a"), (2, 0, "user", "a"), (2, 1, "assistant", ""), (None, None, None, None)] + [
    (c, t, "user", f"{c} {t}") for c in range(3, 20) for t in range(4)]


def test_the_registered_log_folds_to_its_rows(spark):
    rows = spark.createDataFrame(LOGGED, "conv_id long, turn long, role string, text string")
    log = conversation_log(rows)
    kinds = {r.kind: r["count"] for r in log.groupBy("kind").count().collect()}
    assert set(kinds) == {"open", "delta", "edit", "regenerate"} and log.filter("text = 'not said again'").count() > 5
    assert log.count() > log.distinct().count() == log.dropDuplicates(["conv_id", "turn", "copy", "seq"]).count()
    messages = fold_events(log, turn=("turn", "copy"))
    have = sorted((repr(r.conv_id), repr(r.turn), r.role, r["text"]) for r in messages.collect())
    assert have == sorted((repr(c), repr(t), r or "", x or "") for c, t, r, x in LOGGED)


@pytest.mark.parametrize("kind", ["edit", "regenerate"])
def test_every_reset_counts(spark, kind):
    rows = spark.createDataFrame(LOGGED, "conv_id long, turn long, role string, text string")
    messages = fold_events(conversation_log(rows).filter(f"kind <> '{kind}'"), turn=("turn", "copy"))
    have = sorted((repr(r.conv_id), repr(r.turn), r.role, r["text"]) for r in messages.collect())
    assert have != sorted((repr(c), repr(t), r or "", x or "") for c, t, r, x in LOGGED)
