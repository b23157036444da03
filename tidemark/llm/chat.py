"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example of its own: all turns before it are context, and only its text is trained.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import column

# The template.
START, END = "<|im_start|>", "<|im_end|>\n"
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    """No ``<|`` is left: a backslash more stands between ``<`` and ``|`` than before."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role stands on a line of its own, so line feeds (and the sign that marks them) are escaped too."""
    return escape(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(unescape(role), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """``conv_id``, ``example`` (from 0), ``text``, ``loss_start`` and ``loss_length`` (code points of the text).

    One example for each assistant turn. Where turns follow the last one, or there is none, one more example with no
    loss holds them, so that no turn is lost. Rows count as one conversation if their ``conv_id`` is equal, null
    included; they are ordered by turn (null first), then role and text, and repeated rows stay. Null roles and texts
    are empty. Other columns are not read. A conversation is the unit: its turns meet in one row.
    """
    turn = F.struct(
        column("turn").alias("turn"),
        F.coalesce(column("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(column("text").cast("string"), F.lit("")).alias("text"),
    )
    whole = conversations.select(column("conv_id").alias("conv_id"), turn.alias("turn")).groupBy("conv_id").agg(F.array_sort(F.collect_list("turn")).alias("turns"))
    written = F.transform("turns", lambda t: F.concat(F.lit(START), escape_role(t["role"]), F.lit("\n"), escape(t["text"]), F.lit(END)))
    trained = F.transform("turns", lambda t: F.when(t["role"] == TRAINED_ROLE, F.length(escape(t["text"]))).otherwise(-1))
    rows = whole.select("conv_id", written.alias("written"), trained.alias("trained"))
    # Examples end at assistant turns; a last one, without loss, at turns after those.
    targets = F.filter(F.sequence(F.lit(0), F.size("trained") - 1), lambda i: (F.get("trained", i) >= 0) | (i == F.size("trained") - 1))
    examples = rows.select("conv_id", "written", "trained", F.posexplode(targets).alias("example", "last"))
    text = F.array_join(F.slice("written", F.lit(1), F.col("last") + 1), "")
    loss = F.greatest(F.get("trained", F.col("last")), F.lit(0))
    return examples.select("conv_id", "example", text.alias("text"), loss.alias("loss_length")).select(
        "conv_id",
        "example",
        "text",
        F.when(F.col("loss_length") > 0, F.length("text") - len(END) - F.col("loss_length")).otherwise(F.length("text")).alias("loss_start"),
        "loss_length",
    )


def read_turns(text: Column) -> Column:
    """The turns of a formatted text as an array of role and text."""

    def turn(part: Column) -> Column:
        role = F.substring_index(part, "\n", 1)
        body = F.substr(part, F.length(role) + 2, F.length(part) - F.length(role) - 1 - len(END))
        return F.struct(unescape_role(role).alias("role"), unescape(body).alias("text"))

    parts = F.split(text, r"<\|im_start\|>", -1)
    return F.transform(F.slice(parts, F.lit(2), F.size(parts)), turn)


def read_loss(text: Column, start: Column, length: Column) -> Column:
    """The text under the loss mask as it was before formatting."""
    return unescape(F.substr(text, start + 1, length))


def chat_digests(conversations: DataFrame) -> DataFrame:
    """Digests of each conversation, read back from its formatted examples."""
    examples = format_conversations(conversations)
    turns = F.transform(read_turns(F.col("longest")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    loss = read_loss(F.col("text"), F.col("loss_start"), F.col("loss_length"))
    return (
        examples.withColumn("loss", F.struct("example", loss.alias("text")))
        .groupBy("conv_id")
        .agg(
            F.max_by("text", "example").alias("longest"),
            F.array_sort(F.collect_list("loss")).alias("losses"),
            F.sum(F.length("text")).alias("formatted_chars"),
        )
        .select("conv_id", turns.alias("turns"), F.array_join(F.transform("losses", lambda x: x["text"]), "").alias("loss"), "formatted_chars")
        .select(
            "conv_id",
            F.size("turns").cast("long").alias("n_turns"),
            F.sha2(F.array_join("turns", ""), 256).alias("turns_sha256"),
            F.length("loss").cast("long").alias("loss_chars"),
            F.sha2("loss", 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )


DIGEST_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
sized AS (
  SELECT *, length('<|im_start|>' || regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\*)\|', '<\\\1|', 'g') || chr(10)
      || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10)) AS size,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end
  FROM turns),
summed AS (
  SELECT *, sum(size) OVER (PARTITION BY conv_id ORDER BY from_end DESC ROWS UNBOUNDED PRECEDING) AS prefix FROM sized)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY from_end DESC)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY from_end DESC) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(coalesce(sum(prefix) FILTER (role = 'assistant' OR from_end = 1), 0) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""
