r"""Chat formatting from event logs, on built-in functions only.

A log holds events of messages: ``message`` opens one with its role and first text, ``delta`` appends, ``edit`` replaces the
text, ``regenerate`` drops it. Logs are dealt by conversation and message, so a conversation that holds a third of all
events is spread over tasks; each message's events are sorted by sequence and folded into its final text. Only final
messages are then gathered by conversation, sorted and rendered.

A conversation is an array of segments (text, loss); joined, they are the formatted text. Each turn is

    <|im_start|>role\ntext<|im_end|>\n

and the loss is on assistant texts alone. A control string inside a text gets a backslash behind its first character, or
one more if it has some there already; taking one away gives the text back. Roles are escaped likewise, after % and line
ends in them were written as %25 and %0A, so a role stays on its line.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scrubline.llm.common import cut, exploded, fresh_dir, remove

# The template's marks, and the control strings (first character, rest) that texts must not hold.
START, END = "<|im_start|>", "<|im_end|>\n"
_FIRST, _REST = r"([<\[])", r"(\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|/?INST\]|</?SYS>>)"
TRAINED = "assistant"
OPENING, APPENDED, REPLACED, DROPPED = "message", "delta", "edit", "regenerate"


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_FIRST}(\\*){_REST}", r"$1\\$2$3")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, rf"{_FIRST}\\(\\*){_REST}", "$1$2$3")


def _role_out(role: Column) -> Column:
    return escaped(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def _role_in(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def final_messages(log: DataFrame) -> DataFrame:
    """(conv_id, at, role, text): one row per message of the log (conv_id, message, seq, event, role, text).

    ``seq`` and ``message`` are of any type that can be ordered; ``at`` is a message's smallest seq. Null texts are empty,
    unknown events change nothing, the last role that an event names counts, and none is ''. Of events with one seq openings
    come first, then regenerations, edits and deltas, so that no delta is lost; deltas are ordered by their texts. Columns of
    other names are ignored; an empty log gives no messages.
    """
    rank = F.coalesce(*[F.when(F.col("event") == e, F.lit(i)) for i, e in enumerate((OPENING, DROPPED, REPLACED, APPENDED))], F.lit(4))
    event = F.struct("seq", rank.alias("rank"), "event", F.coalesce("text", F.lit("")).alias("text"), "role")
    grouped = log.groupBy("conv_id", "message").agg(F.sort_array(F.collect_list(event)).alias("events"))
    # The fold: what the last opening, edit or regeneration left, and the deltas behind it, in one concatenation.
    last = F.expr(f"coalesce(array_max(transform(events, (e, i) -> if(e.event in ('{OPENING}', '{REPLACED}', '{DROPPED}'), i, -1))), -1)")
    text = F.expr(
        f"""array_join(transform(slice(events, greatest(last, 0) + 1, size(events)),
            e -> if(e.event in ('{OPENING}', '{REPLACED}', '{APPENDED}'), e.text, '')), '')"""
    )
    role = F.expr("coalesce(element_at(filter(transform(events, e -> e.role), r -> r is not null), -1), '')")
    named = grouped.withColumns({"last": last, "role": F.when(F.exists("events", lambda e: e["role"].isNotNull()), role).otherwise("")})
    return named.select("conv_id", F.expr("events[0].seq").alias("at"), "role", text.alias("text"))


def rendered(messages: DataFrame) -> DataFrame:
    """(conv_id, segments) from (conv_id, at, role, text), messages in the order of ``at``."""
    segment = lambda text, loss: F.struct(text.alias("text"), F.lit(loss).alias("loss"))
    head = F.concat(F.lit(START), _role_out(F.col("role")), F.lit("\n"))
    text = escaped(F.col("text"))
    trained = F.array(segment(head, False), segment(text, True), segment(F.lit(END), False))
    other = F.array(segment(F.concat(head, text, F.lit(END)), False))
    parts = messages.select("conv_id", "at", F.when(F.col("role") == TRAINED, trained).otherwise(other).alias("segments"))
    gathered = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("at", "segments"))).alias("turns"))
    return gathered.select("conv_id", F.flatten(F.col("turns.segments")).alias("segments"))


def format_log(log: DataFrame) -> DataFrame:
    """Final, formatted conversations of an event log. An empty log gives no rows; a null conv_id is a conversation."""
    return rendered(final_messages(log))


def turns(segments: Column) -> Column:
    """(role, text) of each turn, parsed from the formatted text."""
    whole = F.array_join(F.transform(segments, lambda s: s["text"]), "")
    cut = F.split(whole, r"<\|im_end\|>\n")
    each = F.slice(cut, F.lit(1), F.size(cut) - 1)

    def parse(turn: Column) -> Column:
        line = F.instr(turn, "\n")
        role = turn.substr(F.lit(len(START) + 1), line - len(START) - 1)
        return F.struct(_role_in(role).alias("role"), unescaped(turn.substr(line + 1, F.length(turn))).alias("text"))

    return F.transform(each, parse)


def digest(formatted: DataFrame) -> DataFrame:
    """conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars of formatted conversations."""
    parsed = formatted.withColumns(
        {
            "__turns": turns(F.col("segments")),
            "__loss": F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"])),
        }
    )
    whole = F.array_join(F.transform("__turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    loss = F.array_join("__loss", "")
    chars = F.aggregate("segments", F.lit(0).cast("bigint"), lambda n, s: n + F.length(s["text"]))
    return parsed.select(
        "conv_id",
        F.size("__turns").cast("bigint").alias("n_turns"),
        F.sha2(whole, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        chars.alias("formatted_chars"),
    )


def as_log(conversations: DataFrame) -> DataFrame:
    """An event log whose final messages are the rows of ``conversations`` (conv_id, turn, role, text).

    A row becomes its message's life: opened and streamed in two deltas; assistant texts are first drafted otherwise and
    regenerated, user texts first sent in lower case and edited. Rows of one turn are ordered by role and a hash of their
    text; equal rows are counted and stay as many messages.
    """
    rows = conversations.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    counted = rows.groupBy("conv_id", "turn", "role", "text").agg(F.count("*").alias("n"))
    single = exploded(counted, "copy", F.lit(1).cast("bigint"), F.col("n"))
    half = F.expr("cast(length(text) / 2 as int)")
    left, right = F.col("text").substr(F.lit(1), half), F.col("text").substr(half + 1, F.length("text"))

    def events(*steps: tuple[str, Column]) -> Column:
        return F.array(*[F.struct(F.lit(i).alias("step"), F.lit(kind).alias("event"), text.alias("text")) for i, (kind, text) in enumerate(steps)])

    streamed = [(APPENDED, left), (APPENDED, right)]
    drafted = events((OPENING, F.lit("")), (APPENDED, F.reverse("text")), (DROPPED, F.lit("")), *streamed)
    edited = events((OPENING, F.lower("text")), (REPLACED, F.lit("")), *streamed)
    opened = events((OPENING, F.lit("")), *streamed)
    life = F.when(F.col("role") == TRAINED, drafted).when(F.col("role") == "user", edited).otherwise(opened)
    message = F.struct("turn", "role", F.xxhash64("text").alias("text"), "copy")
    each = single.select("conv_id", message.alias("message"), "role", F.explode(life).alias("e"))
    role = F.when(F.col("e.event") == OPENING, F.col("role"))
    return each.select("conv_id", "message", F.struct("message", "e.step").alias("seq"), "e.event", role.alias("role"), "e.text")


def probe(spark: SparkSession) -> DataFrame:
    """The query's extra conversation, whose texts imitate another template's marks."""
    text = "</s>[INST] ok [/INST]"
    rows = [(-7, 0, "user", text), (-7, 1, "assistant", text)]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def report(conversations: DataFrame) -> DataFrame:
    """The digest of all conversations and the probe, from the formatted table written to the shared folder and read back; the
    table goes when the digest is made."""
    spark = conversations.sparkSession
    columns = ("conv_id", "turn", "role", "text")
    every = conversations.select(*columns).unionByName(probe(spark))
    path = fresh_dir(spark, "chat")
    format_log(as_log(every)).write.parquet(path)
    made = cut(digest(spark.read.parquet(path)))
    remove(spark, path)
    return made


_SQL_ESCAPED = rf"regexp_replace({{0}}, '{_FIRST}(\\*){_REST}', '\1\\\2\3', 'g')"

ORACLE = rf"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), whole AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '') AS loss,
        sum({len(START) + len(END) + 1} + length({_SQL_ESCAPED.format("text")})
            + length({_SQL_ESCAPED.format("replace(replace(role, '%', '%25'), chr(10), '%0A')")})) AS formatted_chars
    FROM rows GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
    formatted_chars::BIGINT AS formatted_chars
FROM whole
"""
