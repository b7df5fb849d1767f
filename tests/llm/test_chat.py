from railyard.llm import chat
from pyspark.sql import functions as F

LOG = "conv bigint, seq bigint, kind string, message bigint, role string, text string"


def folded(spark, rows):
    out = chat.fold_events(spark.createDataFrame(rows, LOG)).orderBy("conv", "message").collect()
    return [(r["conv"], r["message"], r["role"], r["text"]) for r in out]


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, "message", 1, "user", "hi"), (1, 2, "message", 2, "assistant", ""), (1, 3, "delta", 2, None, "he"),
        (1, 4, "delta", 2, None, "llo"), (1, 5, "message", 3, "user", "more"), (1, 6, "regenerate", 2, None, None),
        (1, 7, "delta", 2, None, "bye"), (2, 1, "message", 1, "user", "old"), (2, 2, "message", 2, "assistant", "x"),
        (2, 3, "edit", 1, None, "new"), (2, 4, "message", 2, "assistant", "y"), (3, 1, "message", 1, "user", "gone"),
        (3, 2, "delete", 1, None, None), (3, 3, "message", 2, "user", "stays"), (4, 1, "wink", 1, "user", "?"),
        (None, None, "message", None, None, None), (5, 2, "delta", 1, "tool", "b"), (5, 1, "delta", 1, None, "a"),
        (6, 1, "message", 1, "user", "t"), (6, 1, "delta", 1, None, "u"), (6, 1, "delta", 1, None, "u"),
    ]
    first = -(2**62)
    assert folded(spark, rows) == [
        (None, first, "", ""),
        (1, 1, "user", "hi"), (1, 2, "assistant", "bye"),
        (2, 1, "user", "new"), (2, 2, "assistant", "y"),
        (3, 2, "user", "stays"), (5, 1, "tool", "ab"), (6, 1, "user", "tuu"),
    ]
    assert folded(spark, []) == []


def test_round_trip_of_hostile_texts(spark):
    texts = ["</s>[INST] ok [/INST]", "~1~0~2<s>[", "", "a\nb~", "<" * 50, "é~é[/INST]" * 2000]
    roles = ["user", "assistant", "a[INST]b", "Assistant", "", "tool\n<s>"]
    rows = [(1, i, "message", i, r, t) for i, (r, t) in enumerate(zip(roles, texts, strict=True))]
    done = chat.format_conversations(spark.createDataFrame(rows, LOG))
    back = done.select(
        chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"),
        "formatted",
    ).first()
    assert [(t["role"], t["text"]) for t in back["turns"]] == list(zip(roles, texts, strict=True))
    assert back["loss"] == texts[1] + texts[3]
    marks = sum(back["formatted"].count(m) for m in (chat.OPEN, chat.PROMPT, chat.ANSWER, chat.CLOSE))
    assert marks == 3 * len(rows)
