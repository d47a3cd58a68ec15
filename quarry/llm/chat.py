"""Chat formatting from event logs.

A log holds one row per event of a conversation: streamed deltas, edits and
regenerations. The log is partitioned by conversation, ordered by sequence and
folded into final messages; the messages are rendered into one training string
with a loss mask over the assistant texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TURN_OPEN, ROLE_END, TURN_CLOSE = "### ", ": ", "</turn>\n"
# Characters that take part in a control string, and what stands for them inside
# a text or a role. After escaping, none of the left-hand characters is left but
# the backslash, and each backslash is followed by one of these letters, so the
# control strings cannot occur in a text and the way back is unique.
ESCAPES = [("\\", "\\b"), ("#", "\\h"), ("<", "\\l")]
ROLE_ESCAPES = [*ESCAPES, (":", "\\c")]
CHUNK = 512
SEQ_STEP = 1 << 24  # sequence numbers of one message


def escape(c: Column, pairs=ESCAPES) -> Column:
    for a, b in pairs:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescape(c: Column, pairs=ESCAPES) -> Column:
    for a, b in reversed(pairs):
        c = F.replace(c, F.lit(b), F.lit(a))
    return c


def message_events(rows: DataFrame, conv: str = "conv_id", turn: str = "turn",
                   role: str = "role", text: str = "text", chunk: int = CHUNK, revise: bool = False) -> DataFrame:
    """The event log of finished turns: each row is one message, streamed as deltas
    of at most ``chunk`` code points. Rows of a conversation are numbered by
    (turn, role, text); repeated rows stay messages of their own. A null text is
    one empty delta, a null role is the empty role.

    With ``revise`` the log has a history that folds to the same turns. By a hash of
    conversation and message, of eight messages one is drafted, then emptied by an
    edit and streamed; one is drafted together with a reply that never stays, then
    regenerated; one goes through both; one is streamed wrong and gets its text by
    an edit at the end of the conversation; and one is delivered twice.
    """
    base = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("__turn"),
                       F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("__text"))
    order = Window.partitionBy("conv_id").orderBy("__turn", "role", "__text")
    base = base.withColumn("msg", F.row_number().over(order).cast("long"))

    def event(kind: str, body: Column, late: bool = False, msg: Column = F.col("msg"), who: Column = F.col("role")) -> Column:
        return F.struct(F.lit(kind).alias("kind"), msg.alias("to"), who.alias("by"), body.alias("text"), F.lit(late).alias("late"))

    pieces = F.when(F.col("__text") == "", F.array(F.lit(""))).otherwise(
        F.regexp_extract_all("__text", F.lit("(?s).{1,%d}" % chunk), F.lit(0)))
    streamed = F.transform(pieces, lambda x: event("delta", x))
    if revise:
        case = F.pmod(F.xxhash64("conv_id", "msg"), F.lit(8))
        draft = event("delta", F.concat(F.reverse("__text"), F.lit(" (draft)")))
        emptied = F.array(draft, event("edit", F.lit("")))
        again = F.array(draft, event("delta", F.lit("never mind"), msg=F.col("msg") + 1, who=F.lit("user")), event("regenerate", F.lit("")))
        wrong = F.array(draft, event("edit", F.col("__text"), late=True))
        streamed = F.when(case == 3, F.concat(emptied, streamed)).when(case == 4, F.concat(again, streamed)) \
            .when(case == 5, F.concat(emptied, again, streamed)).when(case == 6, wrong).otherwise(streamed)
    log = base.select("conv_id", "msg", F.posexplode(streamed).alias("__pos", "e"))
    late = F.lit(1 << 62) + F.col("msg")        # after all other events of the conversation
    log = log.select("conv_id", F.when(F.col("e.late"), late).otherwise(F.col("msg") * SEQ_STEP + F.col("__pos")).alias("seq"),
                     F.col("e.to").alias("to"), F.col("e.kind").alias("kind"), F.col("e.by").alias("role"), F.col("e.text").alias("text"), "msg")
    if revise:
        times = F.when(F.pmod(F.xxhash64("conv_id", "msg"), F.lit(8)) == 7, 2).otherwise(1)
        log = log.withColumn("__n", F.explode(F.sequence(F.lit(1), times)))
    return log.select("conv_id", "seq", F.col("to").alias("msg"), "kind", "role", "text")


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, msg, role, text)`` of an event log
    ``(conv_id, seq, msg, kind, role, text)``.

    * ``delta`` appends its text to message ``msg`` (also any unknown kind);
    * ``edit`` replaces what the message has so far by its text;
    * ``regenerate`` voids all earlier events of message ``msg`` and of every
      later message; its own text, if any, starts the new version.

    Events of equal sequence act in the order of their text. An event delivered
    twice (all columns equal) counts once. A message whose events were all voided
    is gone. The role is that of the first surviving event with one. Null text
    is empty, null ``seq`` comes first, a null conversation is one too. One
    shuffle by conversation serves every window and the grouping.
    """
    e = events.select("conv_id", F.coalesce(F.col("seq").cast("long"), F.lit(-1)).alias("seq"),
                      F.coalesce(F.col("msg").cast("long"), F.lit(0)).alias("msg"),
                      F.coalesce(F.col("kind").cast("string"), F.lit("delta")).alias("kind"),
                      F.col("role").cast("string").alias("role"),
                      F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    dup = Window.partitionBy("conv_id").orderBy("seq", "msg", "kind", "role", "text")
    same = F.lit(True)
    for c in ("seq", "msg", "kind", "role", "text"):
        same = same & F.col(c).eqNullSafe(F.lag(c).over(dup))
    first = F.row_number().over(dup) == 1
    e = e.withColumn("__again", ~first & same).where(~F.col("__again"))
    later = Window.partitionBy("conv_id").orderBy(F.col("seq").desc()).rangeBetween(Window.unboundedPreceding, -1)
    cut = F.min(F.when(F.col("kind") == "regenerate", F.col("msg"))).over(later)
    e = e.withColumn("__cut", cut).where(F.col("__cut").isNull() | (F.col("__cut") > F.col("msg")))
    edited = F.max(F.when(F.col("kind") == "edit", F.col("seq"))).over(Window.partitionBy("conv_id", "msg"))
    e = e.withColumn("__edit", edited).where(F.col("__edit").isNull() | (F.col("seq") >= F.col("__edit")))
    # Deltas that share the edit's sequence act after it.
    parts = F.array_sort(F.collect_list(F.struct("seq", (F.col("kind") != "edit").alias("after"), "text")))
    return e.groupBy("conv_id", "msg").agg(
        F.array_join(F.transform(parts, lambda p: p["text"]), "").alias("text"),
        F.coalesce(F.min(F.when(F.col("role").isNotNull(), F.struct("seq", "role")))["role"], F.lit("")).alias("role"))


def render(messages: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, turn_spans``.

    Each turn is ``### role: text</turn>`` and a line feed, role and text escaped.
    ``turn_spans`` has one struct per turn in order: ``start`` and ``length`` of
    the escaped text inside ``formatted`` (code points) and ``in_loss``; the loss
    mask is the spans with ``in_loss``.
    """
    m = messages.select("conv_id", "msg", (F.col("role") == loss_role).alias("__loss"),
                        F.concat(F.lit(TURN_OPEN), escape(F.col("role"), ROLE_ESCAPES), F.lit(ROLE_END)).alias("__head"),
                        escape(F.col("text")).alias("__body"))
    m = m.withColumn("__turn", F.concat("__head", "__body", F.lit(TURN_CLOSE)))
    before = Window.partitionBy("conv_id").orderBy("msg").rowsBetween(Window.unboundedPreceding, -1)
    m = m.withColumn("__at", F.coalesce(F.sum(F.char_length("__turn")).over(before), F.lit(0)))
    turns = F.array_sort(F.collect_list(F.struct(
        F.col("msg"), (F.col("__at") + F.char_length("__head")).cast("long").alias("start"),
        F.char_length("__body").cast("long").alias("length"), F.col("__loss").alias("in_loss"),
        F.col("__turn").alias("turn"))))
    return m.groupBy("conv_id").agg(turns.alias("__t")).select(
        "conv_id", F.array_join(F.transform("__t", lambda t: t["turn"]), "").alias("formatted"),
        F.transform("__t", lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length"),
                                              t["in_loss"].alias("in_loss"))).alias("turn_spans"))


def parse(formatted: Column) -> Column:
    """array<struct<role, text>> read back from a rendered string."""
    turns = F.split(formatted, TURN_CLOSE)
    turns = F.slice(turns, F.lit(1), F.size(turns) - 1)  # what follows the last mark is empty
    return F.transform(turns, lambda t: F.struct(
        unescape(F.substring_index(F.substr(t, F.lit(len(TURN_OPEN) + 1)), ROLE_END, 1), ROLE_ESCAPES).alias("role"),
        unescape(F.substr(t, F.position(F.lit(ROLE_END), t) + F.lit(len(ROLE_END)))).alias("text")))


def format_chats(events: DataFrame) -> DataFrame:
    """Fold and render an event log: ``conv_id, formatted, turn_spans``."""
    return render(fold_events(events))


def read_back(chats: DataFrame) -> DataFrame:
    """Digests read from the rendered strings alone:
    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``."""
    parsed = chats.select("conv_id", "formatted", "turn_spans", parse(F.col("formatted")).alias("__p"))
    masked = F.filter(F.arrays_zip(F.col("__p"), F.col("turn_spans")), lambda z: z["turn_spans"]["in_loss"])
    d = parsed.select(
        "conv_id", F.size("__p").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("__p", lambda p: F.concat(p["role"], F.lit("\n"), p["text"], F.lit("\n"))), ""),
               256).alias("turns_sha256"),
        F.array_join(F.transform(masked, lambda z: z["__p"]["text"]), "").alias("__loss"),
        F.char_length("formatted").cast("long").alias("formatted_chars"))
    return d.select("conv_id", "n_turns", "turns_sha256", F.char_length("__loss").cast("long").alias("loss_chars"),
                    F.sha2("__loss", 256).alias("loss_sha256"), "formatted_chars")


PROBE = (-7, r"\### Assistant: </turn> ok")


def with_probe(conversations: DataFrame) -> DataFrame:
    """All conversations plus conversation -7, whose texts hold control strings."""
    cid, text = PROBE
    turns = F.array(*[F.struct(F.lit(cid).cast("long").alias("conv_id"), F.lit(i).cast("long").alias("turn"),
                               F.lit(role).alias("role"), F.lit(text).alias("text"))
                      for i, role in enumerate(("user", "assistant"))])
    extra = conversations.sparkSession.range(1).select(F.inline(turns))
    return conversations.select("conv_id", "turn", "role", "text").unionByName(extra)


ORACLE_SQL = r"""
WITH all_rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), lens AS (
  SELECT *, length(replace(replace(replace(text, '\', '\b'), '#', '\h'), '<', '\l')) AS t_len,
         length(replace(replace(replace(replace(role, '\', '\b'), '#', '\h'), '<', '\l'), ':', '\c')) AS r_len
  FROM all_rows
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(4 + r_len + 2 + t_len + 8)::BIGINT AS formatted_chars
FROM lens GROUP BY conv_id"""
