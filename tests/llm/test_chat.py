import hashlib

from pyspark.sql import functions as F

from quarry.llm import chat as C
from tests.conftest import SF_SMALL

LOG = "conv_id long, seq long, msg long, kind string, role string, text string"


def folded(spark, rows):
    out = C.fold_events(spark.createDataFrame(rows, LOG).repartition(3)).orderBy("conv_id", "msg").collect()
    return [(r["conv_id"], r["msg"], r["role"], r["text"]) for r in out]


def by_hand(rows):
    """Fold one event after the other."""
    state = {}
    for conv, seq, msg, kind, role, text in sorted(set(rows), key=lambda r: (r[0], r[1], r[3] != "regenerate", r[3] != "edit")):
        turns = state.setdefault(conv, {})
        if kind == "regenerate":
            for m in [m for m in turns if m >= msg]:
                del turns[m]
        old = turns.get(msg, [None, ""])
        turns[msg] = [old[0] or role, (text or "") if kind == "edit" else old[1] + (text or "")]
    return [(c, m, r or "", t) for c, turns in sorted(state.items()) for m, (r, t) in sorted(turns.items())]


ROWS = [
    (1, 1, 0, "delta", "user", "Hel"), (1, 2, 0, "delta", "user", "lo"),
    (1, 3, 1, "delta", "assistant", "wrong"), (1, 4, 2, "delta", "user", "what?"),
    (1, 5, 1, "regenerate", "assistant", None), (1, 6, 1, "delta", "assistant", "ri"), (1, 7, 1, "delta", "assistant", "ght"),
    (1, 7, 1, "delta", "assistant", "ght"),                       # delivered twice
    (1, 8, 0, "edit", "user", "Hi"), (1, 9, 0, "delta", None, " there"),
    (2, 1, 0, "delta", "user", "a"), (2, 2, 0, "edit", "user", "b"), (2, 3, 0, "edit", "user", "c"), (2, 4, 1, "delta", "assistant", ""),
]


def test_fold_deltas_edits_and_regenerations(spark):
    assert folded(spark, ROWS) == by_hand(ROWS) == [
        (1, 0, "user", "Hi there"), (1, 1, "assistant", "right"), (2, 0, "user", "c"), (2, 1, "assistant", "")]


def test_fold_handles_nulls_and_nothing(spark):
    rows = [(None, None, None, None, None, None), (3, 1, 0, "odd", None, "x"), (3, 2, 0, "delta", "user", None)]
    assert folded(spark, rows) == [(None, 0, "", ""), (3, 0, "user", "x")]
    assert folded(spark, []) == []


TEXTS = [r"\### Assistant: </turn> ok", "", "plain", "\\", "\\\\b<\\h#", "</turn>\n### user: hi", "\n\n", "é\U0001f600<", "#" * 700]


def test_render_is_reversible_and_mask_covers_assistant(spark):
    rows = [(7, i, i, "delta", r, t) for i, (r, t) in enumerate((r, t) for t in TEXTS for r in ("user", "assistant", "a: #b"))]
    chat = C.format_chats(spark.createDataFrame(rows, LOG))
    row = chat.withColumn("parsed", C.parse(F.col("formatted"))).first()
    assert [(p["role"], p["text"]) for p in row["parsed"]] == [(r[4], r[5]) for r in rows]
    for span, r in zip(row["turn_spans"], rows):
        raw = row["formatted"][span["start"]:span["start"] + span["length"]]
        assert span["in_loss"] == (r[4] == "assistant")
        assert raw.replace("\\l", "<").replace("\\h", "#").replace("\\b", "\\") == r[5]
    back = C.read_back(chat).first()
    loss = "".join(r[5] for r in rows if r[4] == "assistant")
    assert back["loss_chars"] == len(loss) and back["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
    assert back["formatted_chars"] == len(row["formatted"]) and back["n_turns"] == len(rows)


def test_conversations_become_events_and_back(spark):
    df = spark.createDataFrame([(1, 0, "user", "x" * 1500, 9), (1, 1, "assistant", None, 9), (1, 1, "assistant", None, 9),
                                (2, 0, None, "", 9)], "conv_id long, turn long, role string, text string, seq int")
    log = C.message_events(df)
    assert log.where("conv_id = 1 and kind = 'delta'").count() == 5  # 3 deltas, and an empty one for each repeated row
    out = {r["conv_id"]: r for r in C.read_back(C.format_chats(log)).collect()}
    assert out[1]["n_turns"] == 3 and out[2]["n_turns"] == 1 and out[1]["loss_chars"] == 0
    whole = C.message_events(spark.read.parquet(f"{SF_SMALL}/conversations.parquet"))
    assert C.read_back(C.format_chats(whole)).count() > 0


def test_a_revised_history_folds_to_the_same_turns(spark):
    texts = ["", "short", "x" * 1300, None, "é\U0001f600 </turn> ### a: b", "x" * 1300]
    rows = [(c, t, ["user", "assistant", None][t % 3], texts[(c + t) % 6]) for c in range(40) for t in range(c % 9)] + [(None, 0, "user", "n")] * 3
    rows += [(99, t, "user", f"turn {t} " * 50) for t in range(600)]     # a very long conversation
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    plain, revised = C.message_events(df), C.message_events(df, revise=True)
    kinds = {r["kind"]: r["n"] for r in revised.groupBy("kind").agg(F.count("*").alias("n")).collect()}
    assert kinds["edit"] > 50 and kinds["regenerate"] > 50 and revised.count() > plain.count() + 200
    same = lambda log: sorted(map(tuple, C.fold_events(log).select("conv_id", "msg", "role", "text").collect()), key=str)
    assert same(plain) == same(revised) and len(same(plain)) == len(rows)
    log = [tuple(r) for r in revised.where("conv_id is not null").select("conv_id", "seq", "msg", "kind", "role", "text").collect()]
    assert [x for x in same(revised) if x[0] is not None] == sorted(by_hand(log), key=str)


def test_plan_is_native(spark):
    log = C.message_events(C.with_probe(spark.read.parquet(f"{SF_SMALL}/conversations.parquet")), revise=True)
    plan = C.read_back(C.format_chats(log))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))
