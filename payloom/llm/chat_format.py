"""Chat formatting with a grammar round trip.

A turn is rendered as `<s>`, an opening of its role, its text, a closing and `</s>`. A deterministic parser reads the rendered text back: turns end at `</s>`, the opening tells the role,
a control string inside a text breaks the grammar, and of each escaped control string one backslash goes. Texts are rendered as they are first; where what the parser
recovers differs from the source, the turn's control strings are escaped, and the whole is parsed and compared again, until both are identical: first each turn by itself,
then whole segments of a conversation, where all turns are escaped if one still differs. A segment that even then isn't recovered stops the job; the escape is reversible, so none is.

Escaping puts a backslash behind the first character of a control string, `<\\/s>`, and one more where some are there already; unescaping takes one away.
The loss mask is read off the parsed text: spans of code points that hold texts of the assistant, and nothing else.

Turns come in order of turn, then role, then text, so ties have one order. Null texts and roles count as empty ones. Repeated rows are turns of their own. Rows without conv_id are one conversation.
Texts may be of any length. An empty table gives no rows. Further columns are ignored, whatever their names.

A conversation may have any number of turns: rows are dealt out by ranges of (conversation, turn), and a conversation is cut into segments of SEGMENT consecutive turns at most
(where ranges meet a segment is shorter). The grammar holds for each segment by itself, and segments put together are the conversation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from payloom.llm.common import read_table

#: Turns of a segment, at most.
SEGMENT = 64
START, END = "<s>", "</s>"
#: What stands in front of and behind the text of each known role.
ROLES = {"system": ("<<SYS>>\n", "\n<</SYS>>"), "user": ("[INST] ", " [/INST]"), "assistant": (" ", " ")}
#: Any other role is named between these.
NAME_OPEN, NAME_CLOSE = "[ROLE]", "[/ROLE]"
#: The first character of a control string, its backslashes, and what must follow.
CONTROL = r"(?:(<)(\\*)(?=/?s>|</?SYS>>)|(\[)(\\*)(?=/?(?:INST|ROLE)\]))"
ESCAPED = CONTROL.replace(r"\\*", r"\\+")
BARE = CONTROL.replace(r"(\\*)", "")
TURN = "struct<role:string,text:string>"


def escape(text: Column) -> Column:
    """One more backslash in each control string."""
    return F.regexp_replace(text, CONTROL, r"$1$3$2$4\\")


def unescape(text: Column) -> Column:
    """One backslash less in each escaped control string."""
    return F.regexp_replace(text, ESCAPED.replace(r"(\\+)", r"\\(\\*)"), "$1$3$2$4")


def render(role: Column, text: Column) -> Column:
    """A turn whose text is escaped already, or needn't be. The name of a role that the template doesn't know is always escaped."""
    marks = [F.when(role == r, F.concat(F.lit(START + a), text, F.lit(b + END))) for r, (a, b) in ROLES.items()]
    return F.coalesce(*marks, F.concat(F.lit(START + NAME_OPEN), escape(role), F.lit(f"{NAME_CLOSE} "), text, F.lit(f" {END}")))


def body(piece: Column) -> Column:
    """(role, start, length) of the raw text in what stands before an END; null where the grammar doesn't hold. start counts from 0."""
    size = F.length(piece)

    def known(role: str) -> Column:
        head, tail = START + ROLES[role][0], ROLES[role][1]
        fits = piece.startswith(head) & piece.endswith(tail) & (size >= len(head) + len(tail))
        return F.when(fits, F.struct(F.lit(role).alias("role"), F.lit(len(head)).alias("start"), (size - len(head) - len(tail)).alias("length")))

    head = F.regexp_extract(piece, rf"(?s)^{START}\[ROLE\](.*?)\[/ROLE\] ", 0)
    name = F.substring(head, F.lit(len(START + NAME_OPEN) + 1), F.length(head) - len(f"{START}{NAME_OPEN}{NAME_CLOSE} "))
    named = F.when((head != "") & piece.endswith(" ") & (size > F.length(head)), F.struct(unescape(name).alias("role"), F.length(head).alias("start"), (size - F.length(head) - 1).alias("length")))
    found = F.coalesce(known("system"), known("user"), named, known("assistant"))
    return F.when(~F.substring(piece, found["start"] + 1, found["length"]).rlike(BARE), found)


def parse(formatted: Column) -> Column:
    """Turns of a rendered text as an array of (role, text, start, end), start and end being the place of the raw text, in code points; broken turns are null throughout."""
    pieces = F.split(formatted, END)  # the last piece is what follows the last END
    placed = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<piece:string,at:int>>").alias("all")),
        lambda acc, p: F.struct((acc["at"] + F.length(p) + len(END)).alias("at"), F.array_append(acc["all"], F.struct(p.alias("piece"), acc["at"].alias("at"))).alias("all")),
        lambda acc: acc["all"],
    )
    ended = F.transform(placed, lambda x, i: F.struct(x["piece"].alias("piece"), x["at"].alias("at"), (i < F.size(pieces) - 1).alias("ended")))
    whole = F.filter(ended, lambda x: x["ended"] | (x["piece"] != ""))

    def turn(x: Column, found: Column) -> Column:
        start = x["at"] + found["start"]
        text = unescape(F.substring(x["piece"], found["start"] + 1, found["length"]))
        return F.struct(found["role"].alias("role"), text.alias("text"), start.alias("start"), (start + found["length"]).alias("end"))

    return F.transform(F.transform(whole, lambda x: F.struct(x.alias("x"), F.when(x["ended"], body(x["piece"])).alias("found"))), lambda y: turn(y["x"], y["found"]))


def recovered(formatted: Column) -> Column:
    """Roles and texts only, for comparison with the source."""
    return F.transform(parse(formatted), lambda t: F.struct(t["role"], t["text"]))


def rendered_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, piece) of every row: each turn rendered as it is if the parser gives it back, else escaped."""
    empty = lambda c: F.coalesce(F.col(c), F.lit(""))
    rows = turns.select("conv_id", "turn", empty("role").alias("role"), empty("text").alias("text")).withColumn("piece", render(F.col("role"), F.col("text")))
    same = recovered(F.col("piece")) == F.array(F.struct("role", "text"))
    return rows.withColumn("piece", F.when(same, F.col("piece")).otherwise(render(F.col("role"), escape(F.col("text")))))


def segments(turns: DataFrame, length: int = SEGMENT) -> DataFrame:
    """(conv_id, segment, turns, formatted, parsed) with at most `length` turns each; segments of a conversation rise in its order.

    Sorted ranges number the rows as they lie, so a long conversation is spread over many tasks, and no window meets it whole."""
    order = ("conv_id", "turn", "role", "text")
    ranged = rendered_turns(turns).repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    groups = ranged.groupBy("conv_id", F.floor(F.col("at") / length).alias("segment")).agg(F.array_sort(F.collect_list(F.struct("at", "role", "text", "piece"))).alias("rows"))
    turned = groups.select("conv_id", "segment", F.transform("rows", lambda r: F.struct(r["role"], r["text"])).cast(f"array<{TURN}>").alias("turns"), F.array_join(F.transform("rows", lambda r: r["piece"]), "").alias("formatted"))
    parsed = turned.withColumn("parsed", parse(F.col("formatted")))
    same = F.transform("parsed", lambda t: F.struct(t["role"], t["text"])) == F.col("turns")
    escaped = F.array_join(F.transform("turns", lambda t: render(t["role"], escape(t["text"]))), "")
    again = parsed.withColumn("formatted", F.when(same, F.col("formatted")).otherwise(escaped)).withColumn("parsed", F.when(same, F.col("parsed")).otherwise(parse(F.col("formatted"))))
    return again.withColumn("parsed", F.when(same, F.col("parsed")).otherwise(F.raise_error(F.lit("a segment isn't recovered from its own text"))))


def format_conversations(turns: DataFrame, length: int = SEGMENT) -> DataFrame:
    """(conv_id, segment, formatted, n_turns, loss_spans): texts to train on, and the spans (start, end) of code points that count in the loss. The spans leave out the marks of a turn."""
    spans = F.transform(F.filter("parsed", lambda t: t["role"] == "assistant"), lambda t: F.struct(t["start"], t["end"]))
    return segments(turns, length).select("conv_id", "segment", "formatted", F.size("parsed").alias("n_turns"), spans.alias("loss_spans"))


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, segment, turns, loss) from formatted texts and loss spans alone: the recovered turns, and all text under the mask, unescaped."""
    loss = F.array_join(F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["end"] - s["start"]))), "")
    return formatted.select("conv_id", "segment", "formatted", recovered(F.col("formatted")).alias("turns"), loss.alias("loss"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row of digests for each conversation, from the segments' own. A digest is taken over one conversation's texts in order, as the contract has it."""
    planted = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    rows = read_back(format_conversations(turns))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    each = rows.select("conv_id", "segment", F.size("turns").alias("n"), said.alias("said"), "loss", F.length("formatted").alias("chars"))
    whole = lambda c: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("segment", c))), lambda x: x[c]), ""), 256)
    return each.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"),
        whole("said").alias("turns_sha256"),
        F.sum(F.length("loss")).cast("long").alias("loss_chars"),
        whole("loss").alias("loss_sha256"),
        F.sum("chars").cast("long").alias("formatted_chars"),
    )


def sql() -> str:
    """The query in DuckDB's SQL: what must come out, from the source and the template's lengths."""
    control = r"<\\*/?s>|<\\*</?SYS>>|\[\\*/?(?:INST|ROLE)\]"
    grown = lambda c: f"length({c}) + len(regexp_extract_all({c}, '{control}'))"
    marks = " ".join(f"WHEN '{r}' THEN {len(a + b)}" for r, (a, b) in ROLES.items())
    named = len(f"{NAME_OPEN}{NAME_CLOSE}  ")
    return f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum({len(START + END)} + {grown('text')} + CASE role {marks} ELSE {named} + {grown('role')} END) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id"""
