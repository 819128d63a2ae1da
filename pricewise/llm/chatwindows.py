r"""Chat formatting in budgeted windows, by DataFrame functions alone.

A conversation becomes one or more training windows. Prefix sums of the turns' tokens
(without the system turn) choose turn-aligned spans: with ``room`` tokens for new turns,
the turns that begin and end inside one multiple of ``room`` are a span, and a turn that
reaches over such a limit is a span of its own. So no span holds more than ``room``
tokens unless one turn alone does. A window holds the conversation's system turn (if its
first turn is one), the turns before the span that begin at most ``history`` tokens
earlier, and the span; room = budget - history - the system turn's tokens (1 at least).
The loss mask covers the texts of the span's assistant turns only, so a target repeated
as history is masked: over all windows of a conversation every assistant text is a
target once.

The template, as in common instruction formats:

    <s>[SYS] text [/SYS][INST] text [/INST][ANS] text </s>[ROLE] name [TEXT] text [/ROLE]

for system, user, assistant and any other role. Its control strings are escaped in texts
and names: a control string whose first sign is followed by n backslashes (n = 0 for the
string itself) gets n + 1 of them. That can be undone, and no text holds a control
string any more, so ``read_back`` finds turns by the marks alone.

Scale: rows are shuffled once, by conversation; running sums, windows and what is read
back keep that partitioning. A window is bounded by the budget (or one longer turn). A
conversation is one unit: its turns are sorted by one task, which spills.

Tokens are counted by ``tokens`` (a column; default: a quarter of the text's UTF-8 bytes,
rounded up) plus OVERHEAD for the marks of a turn.

Edge cases: null text and null role are empty; null conversation ids form one
conversation; turns come by turn number, nulls first, ties by role, then text; repeated
rows are turns each; a conversation of a system turn alone is one window; a turn longer
than the room stands alone, whole; an empty table gives no windows; other columns,
whatever their names, are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET = 1024
HISTORY = 256
OVERHEAD = 4

BEGIN = "<s>"
#: Opening and closing mark of each role; any other role stands between ROLE and TEXT.
MARKS = {"system": ("[SYS] ", " [/SYS]"), "user": ("[INST] ", " [/INST]"), "assistant": ("[ANS] ", " </s>")}
OTHER = ("[ROLE] ", " [TEXT] ", " [/ROLE]")
_NAMES = r"/?(?:s>|INST\]|SYS\]|ANS\]|ROLE\]|TEXT\])"
CONTROL = rf"([<\[])(\\*)({_NAMES})"
ESCAPED = rf"([<\[]\\*)\\({_NAMES})"
#: One turn of a window: its opening mark, what stands inside, its closing mark.
TURN = r"(?s)\[(SYS|INST|ANS|ROLE)\] (.*?) (?:\[/SYS\]|\[/INST\]|</s>|\[/ROLE\])"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def default_tokens(text: Column) -> Column:
    return F.ceil(F.octet_length(text) / 4).cast("long")


def format_turn(role: Column, text: Column) -> Column:
    """One turn between its marks."""
    body = escape(text)
    other = F.concat(F.lit(OTHER[0]), escape(role), F.lit(OTHER[1]), body, F.lit(OTHER[2]))
    out = None
    for name, (a, b) in MARKS.items():
        marked = F.concat(F.lit(a), body, F.lit(b))
        out = F.when(role == name, marked) if out is None else out.when(role == name, marked)
    return out.otherwise(other)


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, tokens: Column | None = None) -> DataFrame:
    """(conv_id, window, text, n_tokens, n_repeated, loss): ``loss`` holds the [start, end)
    of each target in code points of ``text``, ``n_repeated`` the number of leading turns
    that an earlier window had already."""
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    # no input name is kept but these, so none can clash
    rows = conversations.select("conv_id", "turn", role.alias("role"), text.alias("text"),
                                (F.lit(OVERHEAD) + (default_tokens(text) if tokens is None else F.coalesce(tokens.cast("long"), F.lit(0)))).alias("tokens"))
    rows = rows.withColumn("fmt", format_turn(F.col("role"), F.col("text"))).withColumn("chars", F.char_length("fmt").cast("long"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    so_far = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("n", F.row_number().over(order))
    rows = rows.withColumn("is_system", (F.col("n") == 1) & (F.col("role") == "system"))
    new = ~F.col("is_system")

    def running(name: str) -> Column:
        return F.coalesce(F.sum(F.when(new, F.col(name))).over(before), F.lit(0)).cast("long")

    rows = rows.withColumns({
        "start": running("tokens"), "char_start": running("chars"),
        "system": F.first(F.when(F.col("is_system"), F.struct("fmt", "chars", "tokens"))).over(so_far)})
    room = F.greatest(F.lit(1), F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0)))
    rows = rows.withColumn("stretch", F.floor(F.col("start") / room))
    rows = rows.withColumn("over", F.col("start") + F.col("tokens") > (F.col("stretch") + 1) * room)
    first = new & (F.coalesce(F.lag("is_system").over(order), F.lit(True)) | (F.lag("stretch").over(order) != F.col("stretch")) | (F.lag("over").over(order) != F.col("over")))
    rows = rows.withColumn("is_first", first)
    by_start = Window.partitionBy("conv_id").orderBy("start").rangeBetween(-history, -1)
    rows = rows.withColumns({
        "window": F.greatest(F.lit(1), F.sum(F.col("is_first").cast("int")).over(so_far)).cast("int"),
        "repeat": F.collect_list(F.when(new, F.struct("start", "fmt", "chars", "tokens"))).over(by_start)})
    by_place = F.sort_array(F.collect_list(F.when(new, F.struct("start", "fmt", "chars", "tokens", "char_start", "role"))))
    grouped = rows.groupBy("conv_id", "window").agg(
        by_place.alias("span"), F.first("system").alias("system"), F.first(F.when(F.col("is_first"), F.col("repeat")), ignorenulls=True).alias("repeat"))
    none = F.array().cast("array<struct<start:bigint,fmt:string,chars:bigint,tokens:bigint>>")
    grouped = grouped.withColumn("repeat", F.sort_array(F.coalesce("repeat", none)))

    def total(array: str, name: str) -> Column:
        return F.aggregate(array, F.lit(0).cast("long"), lambda a, t: a + t[name])

    has_system = F.col("system").isNotNull()
    base = F.lit(len(BEGIN)) + F.coalesce(F.col("system.chars"), F.lit(0)) + total("repeat", "chars")
    opening, closing = (len(m) for m in MARKS["assistant"])
    shift = F.col("base") - F.get("span", 0)["char_start"]
    loss = F.transform(F.filter("span", lambda t: t["role"] == "assistant"),
                       lambda t: F.struct((shift + t["char_start"] + opening).alias("start"), (shift + t["char_start"] + t["chars"] - closing).alias("end")))
    return grouped.withColumn("base", base).select(
        "conv_id", "window",
        F.concat(F.lit(BEGIN), F.coalesce(F.col("system.fmt"), F.lit("")), F.array_join(F.transform("repeat", lambda t: t["fmt"]), ""),
                 F.array_join(F.transform("span", lambda t: t["fmt"]), "")).alias("text"),
        (F.coalesce(F.col("system.tokens"), F.lit(0)) + total("repeat", "tokens") + total("span", "tokens")).alias("n_tokens"),
        (F.size("repeat") + F.when(has_system & (F.col("window") > 1), 1).otherwise(0)).alias("n_repeated"),
        F.when(F.size("span") > 0, loss).otherwise(F.filter(loss, lambda _: F.lit(False))).alias("loss"))


def parse(text: Column) -> Column:
    """The turns of a window's text, in order: array of (role, text), unescaped."""
    roles = F.create_map(*(F.lit(x) for name, (mark, _) in MARKS.items() for x in (mark[1:-2], name)))

    def turn(raw: Column) -> Column:
        tag, inside = F.regexp_extract(raw, TURN, 1), F.regexp_extract(raw, TURN, 2)
        cut = F.instr(inside, OTHER[1])
        other = tag == OTHER[0][1:-2]
        name = F.when(other, unescape(F.substring(inside, F.lit(1), cut - 1))).otherwise(F.element_at(roles, tag))
        body = F.when(other, F.substring(inside, cut + len(OTHER[1]), F.char_length(inside))).otherwise(inside)
        return F.struct(name.alias("role"), unescape(body).alias("text"))

    return F.transform(F.regexp_extract_all(text, F.lit(TURN), F.lit(0)), turn)


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, targets, formatted_chars) from the windows' texts and masks alone:
    the turns without repeats, the texts under the mask, the code points of all windows."""
    target = F.transform("loss", lambda s: unescape(F.substring(F.col("text"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    turns = parse(F.col("text"))
    each = formatted.select("conv_id", "window", F.char_length("text").cast("long").alias("chars"),
                            F.slice(turns, F.col("n_repeated") + 1, F.greatest(F.size(turns), F.lit(0))).alias("turns"), target.alias("targets"))
    whole = each.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("window", "turns", "targets"))).alias("w"), F.sum("chars").alias("formatted_chars"))
    return whole.select("conv_id", F.flatten(F.transform("w", lambda w: w["turns"])).alias("turns"),
                        F.flatten(F.transform("w", lambda w: w["targets"])).alias("targets"), "formatted_chars")


def digests(back: DataFrame) -> DataFrame:
    """The contract's columns of conversations read back."""
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    targets = F.array_join("targets", "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
                       F.char_length(targets).cast("long").alias("loss_chars"), F.sha2(targets.cast("binary"), 256).alias("loss_sha256"), "formatted_chars")


SQL = rf"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, row_number() OVER w AS n,
         {OVERHEAD} + ceil(strlen(text) / 4.0)::BIGINT AS tokens,
         length(text) + len(regexp_extract_all(text, '[<\[]\\*{_NAMES}'))
         + CASE role WHEN 'system' THEN 13 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11
                ELSE 7 + length(role) + len(regexp_extract_all(role, '[<\[]\\*{_NAMES}')) + 8 + 8 END AS chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
s AS (
  SELECT *, n = 1 AND role = 'system' AS sys, first(n = 1 AND role = 'system') OVER (PARTITION BY conv_id ORDER BY n) AS has_sys,
         first(tokens) OVER (PARTITION BY conv_id ORDER BY n) AS t1, first(chars) OVER (PARTITION BY conv_id ORDER BY n) AS c1 FROM t),
p AS (
  SELECT *, CASE WHEN has_sys THEN c1 ELSE 0 END AS sys_chars, greatest(1, {BUDGET - HISTORY} - CASE WHEN has_sys THEN t1 ELSE 0 END) AS room,
         coalesce(sum(CASE WHEN sys THEN 0 ELSE tokens END) OVER (PARTITION BY conv_id ORDER BY n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM s),
k AS (SELECT *, start // room AS k, start + tokens > (start // room + 1) * room AS over_ FROM p),
f AS (
  SELECT *, NOT sys AND (coalesce(lag(sys) OVER w, true) OR lag(k) OVER w <> k OR lag(over_) OVER w <> over_) AS head,
         coalesce(sum(CASE WHEN sys THEN 0 ELSE chars END) OVER (PARTITION BY conv_id ORDER BY start RANGE BETWEEN {HISTORY} PRECEDING AND 1 PRECEDING), 0) AS back
  FROM k WINDOW w AS (PARTITION BY conv_id ORDER BY n))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       length(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '')) AS loss_chars,
       sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY n), '')) AS loss_sha256,
       (sum(CASE WHEN sys THEN 0 ELSE chars END) + greatest(1, sum(head::INT)) * ({len(BEGIN)} + any_value(sys_chars)) + sum(CASE WHEN head THEN back ELSE 0 END))::BIGINT AS formatted_chars
FROM f GROUP BY conv_id
"""
