"""Chat formatting with budgeted windows, in DataFrame functions only.

Prefix sums of turn tokens choose the windows. With room for ``room`` tokens of new turns,
the token line of a conversation is cut into cells of that length: turns wholly inside a
cell form one window, a turn across a border forms its own. So windows are aligned to turns
and no window of several turns exceeds the budget, without walking through the turns one
after the other. Each window repeats the opening system turn and up to ``history_turns``
preceding turns of at most ``history`` tokens; what is repeated is outside the loss mask,
so each assistant text is a target exactly once.

A turn is written ``<|im_start|>role``, newline, text, ``<|im_end|>``, newline. Control
strings inside texts get a backslash behind their first character, and backslashes are
doubled, which can be undone. Tokens are estimated as a quarter of the characters plus
``TURN_TOKENS`` per turn. The room is the budget less system turn and history, but at least
an eighth of the budget, so only a very long system turn or single turn exceeds the budget.

Everything after one shuffle by conversation happens inside its partition. A conversation
is one record, as its digest has to be; turns of one conversation meet in one task.

Defined cases: rows are ordered by turn (null first), equal turns by role, then text;
repeated rows are turns of their own; a null text or role is empty, newlines in a role are
blanks; a null conversation id is a conversation; a conversation of one system turn is one
window; an empty table gives no windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BEGIN = "<|im_start|>"
END = "<|im_end|>\n"
CONTROL = ("<|", "</s>", "<s>", "<<SYS>>", "<</SYS>>", "[INST]", "[/INST]")
BUDGET = 1024
HISTORY = 256
TURN_TOKENS = 8

_TURN = r"(?s)<\|im_start\|>((?:[^\n\\]++|\\.)*+)\n(.*?)<\|im_end\|>\n"


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for control in CONTROL:
        out = F.replace(out, F.lit(control), F.lit(f"{control[0]}\\{control[1:]}"))
    return out


def escape_role(role: Column) -> Column:
    """A role on one line: line feeds are escaped too."""
    return F.replace(escape(role), F.lit("\n"), F.lit("\\\n"))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY
) -> DataFrame:
    """(conv_id, window, formatted, n_tokens, n_repeated, loss_spans), one row per window.

    ``n_repeated`` leading turns stand in an earlier window already. ``loss_spans`` are
    (start, end) code points of ``formatted`` that are targets, as escaped text.
    """
    by_turn = Window.partitionBy("conv_id").orderBy("seq")
    whole = Window.partitionBy("conv_id")
    rows = turns.select(
        "conv_id",
        F.col("turn").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    head = F.concat(F.lit(BEGIN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    rows = rows.withColumn("seq", F.row_number().over(order)).select(
        "conv_id",
        "seq",
        ((F.col("seq") == 1) & (F.col("role") == "system")).alias("opening"),
        (F.ceil(F.length("text") / 4) + TURN_TOKENS).alias("tokens"),
        F.struct(
            F.concat(head, body, F.lit(END)).alias("piece"),
            F.when(F.col("role") == "assistant", F.length(head)).alias("target"),
            F.length(body).alias("length"),
        ).alias("turn"),
    )
    new_tokens = F.when(F.col("opening"), 0).otherwise(F.col("tokens"))
    rows = rows.withColumns(
        {
            "system": F.max(F.when(F.col("opening"), F.struct("turn.piece", "tokens"))).over(whole),
            "n": F.count("*").over(whole),
            "end": F.sum(new_tokens).over(by_turn),
            "one": F.lag(F.struct("opening", "tokens", "turn"), 1).over(by_turn),
            "two": F.lag(F.struct("opening", "tokens", "turn"), 2).over(by_turn),
        }
    )
    system_tokens = F.coalesce("system.tokens", F.lit(0))
    room = F.greatest(F.lit(budget - history) - system_tokens, F.lit(max(1, budget // 8)))
    first_cell = F.floor((F.col("end") - new_tokens) / room)
    last_cell = F.floor((F.col("end") - 1) / room)
    rows = rows.filter(~F.col("opening") | (F.col("n") == 1)).withColumn(
        "span", 2 * first_cell + F.when(first_cell == last_cell, 0).otherwise(1)
    )
    starts = F.coalesce(F.lag("span").over(by_turn) != F.col("span"), F.lit(True))
    near = F.coalesce(~F.col("one.opening") & (F.col("one.tokens") <= history), F.lit(False))
    far = near & F.coalesce(
        ~F.col("two.opening") & (F.col("one.tokens") + F.col("two.tokens") <= history),
        F.lit(False),
    )
    past = F.when(
        starts,
        F.concat(
            F.when(far, F.array("two.turn.piece")).otherwise(F.array().cast("array<string>")),
            F.when(near, F.array("one.turn.piece")).otherwise(F.array().cast("array<string>")),
        ),
    )
    past_tokens = F.when(
        starts,
        F.when(far, F.col("two.tokens")).otherwise(0)
        + F.when(near, F.col("one.tokens")).otherwise(0),
    )
    spans = (
        rows.withColumns({"past": past, "past_tokens": past_tokens})
        .groupBy("conv_id", "span")
        .agg(
            F.array_sort(F.collect_list(F.struct("seq", "turn", "opening"))).alias("turns"),
            F.first("past", ignorenulls=True).alias("past"),
            F.first("system").alias("system"),
            (F.sum("tokens") + F.max("past_tokens") + F.first(system_tokens)).alias("n_tokens"),
        )
    )
    # An opening system turn that stands alone is its window's own turn.
    system = F.when(
        F.col("system").isNull() | F.col("turns")[0]["opening"],
        F.array().cast("array<string>"),
    ).otherwise(F.array("system.piece"))
    number = F.row_number().over(Window.partitionBy("conv_id").orderBy("span")) - 1
    spans = spans.withColumns({"system": system, "window": number})
    prefix = F.array_join(F.concat("system", "past"), "")
    empty = F.array().cast("array<struct<start:int,end:int>>")

    def place(state, x):
        start = state["at"] + x["turn"]["target"]
        span = F.struct(start.alias("start"), (start + x["turn"]["length"]).alias("end"))
        spans = F.when(x["turn"]["target"].isNull(), state["spans"]).otherwise(
            F.concat(state["spans"], F.array(span))
        )
        at = state["at"] + F.length(x["turn"]["piece"])
        return F.struct(at.alias("at"), spans.alias("spans"))

    state = F.struct(F.length(prefix).alias("at"), empty.alias("spans"))
    return spans.select(
        "conv_id",
        "window",
        F.concat(
            prefix, F.array_join(F.transform("turns", lambda x: x["turn"]["piece"]), "")
        ).alias("formatted"),
        "n_tokens",
        (F.size("past") + F.when(F.col("window") > 0, F.size("system")).otherwise(0)).alias(
            "n_repeated"
        ),
        F.aggregate("turns", state, place, lambda s: s["spans"]).alias("loss_spans"),
    )


def read_turns(formatted: Column) -> Column:
    """The (role, text) turns of a formatted window."""
    pairs = F.arrays_zip(
        F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(1)).alias("role"),
        F.regexp_extract_all(formatted, F.lit(_TURN), F.lit(2)).alias("text"),
    )
    return F.transform(
        pairs,
        lambda t: F.struct(
            unescape(t["role"]).alias("role"), unescape(t["text"]).alias("text")
        ),
    )


def windows_report(windows: DataFrame) -> DataFrame:
    """Conversations as read back from their windows: digests of turns and targets."""
    turns = read_turns(F.col("formatted"))
    new = F.slice(turns, F.col("n_repeated") + 1, F.greatest(F.size(turns), F.lit(1)))
    loss = F.transform(
        "loss_spans",
        lambda s: unescape(F.substr("formatted", s["start"] + 1, s["end"] - s["start"])),
    )
    read = windows.select(
        "conv_id",
        "window",
        F.length("formatted").alias("chars"),
        F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))).alias(
            "turns"
        ),
        loss.alias("loss"),
    )
    joined = read.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("w"),
        F.sum("chars").cast("bigint").alias("formatted_chars"),
        F.count("*").alias("n_windows"),
    )
    turns = F.flatten(F.transform("w", lambda x: x["turns"]))
    target = F.array_join(F.flatten(F.transform("w", lambda x: x["loss"])), "")
    return joined.select(
        "conv_id",
        F.size(turns).cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length(target).cast("bigint").alias("loss_chars"),
        F.sha2(target, 256).alias("loss_sha256"),
        "formatted_chars",
        "n_windows",
    )


_ESCAPED = "replace({}, '\\', '\\\\')"
for _control in CONTROL:
    _ESCAPED = f"replace({_ESCAPED}, '{_control}', '{_control[0]}\\{_control[1:]}')"

#: The report over conversations and the extra conversation -7, for DuckDB.
SQL = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role,
         coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
),
numbered AS (
  SELECT *, row_number() OVER (
    PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS seq FROM given
),
sized AS (
  SELECT conv_id, seq, role, text, seq = 1 AND role = 'system' AS opening,
         (length(text) + 3) // 4 + {TURN_TOKENS} AS tokens,
         {len(BEGIN) + 1 + len(END)} + length({_ESCAPED.format("role")})
           + length(role) - length(replace(role, chr(10), ''))
           + length({_ESCAPED.format("text")}) AS size
  FROM numbered
),
summed AS (
  SELECT *, max(CASE WHEN opening THEN tokens END) OVER c AS system_tokens,
         max(CASE WHEN opening THEN size END) OVER c AS system_size,
         count(*) OVER c AS n,
         sum(CASE WHEN opening THEN 0 ELSE tokens END) OVER t AS ends,
         lag(tokens) OVER t AS tokens1, lag(size) OVER t AS size1, lag(opening) OVER t AS open1,
         lag(tokens, 2) OVER t AS tokens2, lag(size, 2) OVER t AS size2,
         lag(opening, 2) OVER t AS open2
  FROM sized
  WINDOW c AS (PARTITION BY conv_id), t AS (PARTITION BY conv_id ORDER BY seq)
),
celled AS (
  SELECT *, greatest({BUDGET - HISTORY} - coalesce(system_tokens, 0), {BUDGET // 8}) AS room
  FROM summed WHERE NOT opening OR n = 1
),
spanned AS (
  SELECT *, floor((ends - CASE WHEN opening THEN 0 ELSE tokens END) / room::DOUBLE) AS cell,
         floor((ends - 1) / room::DOUBLE) AS last_cell
  FROM celled
),
opened AS (
  SELECT *, 2 * cell + CASE WHEN cell = last_cell THEN 0 ELSE 1 END AS span FROM spanned
),
started AS (
  SELECT *, coalesce(lag(span) OVER (PARTITION BY conv_id ORDER BY seq) <> span, true) AS starts,
         coalesce(NOT open1 AND tokens1 <= {HISTORY}, false) AS near,
         coalesce(NOT open2 AND tokens1 + tokens2 <= {HISTORY}, false) AS far
  FROM opened
),
chars AS (
  SELECT conv_id, count(*) FILTER (WHERE starts)::BIGINT AS n_windows,
         sum(size + CASE WHEN starts THEN
               CASE WHEN opening THEN 0 ELSE coalesce(system_size, 0) END
               + CASE WHEN near THEN size1 ELSE 0 END
               + CASE WHEN near AND far THEN size2 ELSE 0 END
             ELSE 0 END)::BIGINT AS formatted_chars
  FROM started GROUP BY conv_id
),
texts AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq) AS turns,
         coalesce(string_agg(text, '' ORDER BY seq) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM numbered GROUP BY conv_id
)
SELECT texts.conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars, n_windows
FROM texts JOIN chars ON texts.conv_id IS NOT DISTINCT FROM chars.conv_id
"""
