r"""Chat formatting: records of any known layout to canonical turns, then to one template.

Schema fingerprint: the nested field paths of each record (without value types) are hashed, and
the hash selects a declarative ``Layout`` that says where roles and texts lie. It is taken per row
from VARIANT data, so one column may mix layouts. Records of an unknown shape keep their row with
``layout`` null and no turns.

Template: ``<|turn|>role<|text|>text<|end|>`` newline, per turn. Control strings inside texts and
roles (this template's and the common ``<s> </s> [INST] [/INST]``) get a backslash after their
first character, and backslashes are doubled, so every text reads back exactly.

Built-in functions only. A conversation is put together in parts of ``PART`` turn numbers, so a
long one is escaped, measured and read back by many tasks; only its final strings meet.

Rows: null role or text is empty; null turn comes first; equal turns are ordered by role, then
text; repeated rows count as often as they occur; a null conversation id is one conversation. An
empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.llm.common import table

PART = 256
TURN, TEXT, END = "<|turn|>", "<|text|>", "<|end|>\n"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Layout:
    """``shape``: field paths as ``fields_of`` gives them. Either ``list_path`` with role and text
    fields of its items, or ``parts``: (role, paths whose non-empty texts are joined by newline)."""

    name: str
    shape: str
    list_path: str | None = None
    role: str = "role"
    text: str = "text"
    parts: tuple[tuple[str, tuple[str, ...]], ...] = ()


#: Field layouts in common use, and the role names that stand for the canonical ones.
LAYOUTS = (
    Layout("turn_row", "OBJECT<role, text>", role="role", text="text", list_path=""),
    Layout("content_row", "OBJECT<content, role>", role="role", text="content", list_path=""),
    Layout("messages", "OBJECT<messages: ARRAY<OBJECT<content, role>>>", "$.messages", text="content"),
    Layout("dialog", "OBJECT<conversations: ARRAY<OBJECT<from, value>>>", "$.conversations", "from", "value"),
    Layout("dialog_id", "OBJECT<conversations: ARRAY<OBJECT<from, value>>, id>", "$.conversations", "from", "value"),
    Layout("turns", "OBJECT<turns: ARRAY<OBJECT<role, text>>>", "$.turns"),
    Layout("instruction", "OBJECT<input, instruction, output>", parts=(("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Layout("instruction_only", "OBJECT<instruction, output>", parts=(("user", ("$.instruction",)), ("assistant", ("$.output",)))),
    Layout("system_instruction", "OBJECT<input, instruction, output, system>", parts=(("system", ("$.system",)), ("user", ("$.instruction", "$.input")), ("assistant", ("$.output",)))),
    Layout("prompt_completion", "OBJECT<completion, prompt>", parts=(("user", ("$.prompt",)), ("assistant", ("$.completion",)))),
    Layout("prompt_response", "OBJECT<prompt, response>", parts=(("user", ("$.prompt",)), ("assistant", ("$.response",)))),
    Layout("question_answer", "OBJECT<answer, question>", parts=(("user", ("$.question",)), ("assistant", ("$.answer",)))),
    Layout("nested_prompt", "OBJECT<prompt: OBJECT<text>, response: OBJECT<text>>", parts=(("user", ("$.prompt.text",)), ("assistant", ("$.response.text",)))),
)
#: Fixed values.
ROLE_NAMES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


def fields_of(record: Column) -> Column:
    """Nested field paths of a VARIANT in one text: names in order, without the types of values."""
    shape = F.schema_of_variant(record)
    shape = F.regexp_replace(shape, r": (?!OBJECT<|ARRAY<)[A-Z_ ]+(\([0-9, ]+\))?(?=[,>])", "")
    return F.regexp_replace(shape, r"ARRAY<(?!OBJECT<|ARRAY<)[A-Z_ ]+(\([0-9, ]+\))?>", "ARRAY<>")


def _text(record: Column, path: str) -> Column:
    return F.coalesce(F.try_variant_get(record, path, "string"), F.lit(""))


def _canonical(role: Column) -> Column:
    named = F.element_at(F.create_map(*[F.lit(x) for pair in ROLE_NAMES.items() for x in pair]), role)
    return F.coalesce(named, role, F.lit(""))


def _turns(record: Column, layout: Layout) -> Column:
    if layout.list_path == "":
        one = F.struct(_text(record, f"$.{layout.role}").alias("role"), _text(record, f"$.{layout.text}").alias("text"))
        return F.array(one).cast(TURNS)
    if layout.list_path is not None:
        items = F.try_variant_get(record, layout.list_path, "array<variant>")
        return F.transform(
            items,
            lambda x: F.struct(
                _canonical(F.try_variant_get(x, f"$.{layout.role}", "string")).alias("role"),
                _text(x, f"$.{layout.text}").alias("text"),
            ),
        ).cast(TURNS)
    made = [
        F.struct(
            F.lit(role).alias("role"),
            F.array_join(F.filter(F.array(*[_text(record, p) for p in paths]), lambda t: t != ""), "\n").alias("text"),
        )
        for role, paths in layout.parts
    ]
    return F.filter(F.array(*made), lambda t: (t["text"] != "") | (t["role"] != "system")).cast(TURNS)


def canonical_turns(records: DataFrame, record: Column, layouts: tuple[Layout, ...] = LAYOUTS) -> DataFrame:
    """Adds ``fingerprint``, ``layout`` and ``turns`` to records, whose VARIANT ``record`` is.

    Existing columns of these names are replaced.
    """
    named = records.withColumn("fingerprint", F.xxhash64(fields_of(record)))
    pick, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for layout in reversed(layouts):
        fits = F.col("fingerprint") == F.xxhash64(F.lit(layout.shape))
        pick, turns = F.when(fits, layout.name).otherwise(pick), F.when(fits, _turns(record, layout)).otherwise(turns)
    return named.withColumns({"layout": pick, "turns": turns})


def escape(text: Column) -> Column:
    return F.regexp_replace(
        F.replace(text, F.lit("\\"), F.lit("\\\\")), r"<(?=\||/?s>)|\[(?=/?INST\])", r"$0\\"
    )


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\?)", "$1")


def format_turns(turns: DataFrame) -> DataFrame:
    """(conv_id, part, formatted, loss_spans) of rows (conv_id, turn, role, text).

    ``loss_spans`` are (start, length) in code points of the part's assistant texts; a training
    loss counts there only. Parts follow one another by ``part``; each holds whole turns.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select(
        "conv_id",
        F.floor(F.col("turn") / PART).alias("part"),
        F.struct(F.col("turn"), role.alias("role"), text.alias("text")).alias("key"),
    )
    whole = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list("key")).alias("keys"))
    pieces = F.transform(
        "keys",
        lambda k: F.struct(
            F.concat(F.lit(TURN), escape(k["role"]), F.lit(TEXT)).alias("head"),
            escape(k["text"]).alias("body"),
            (k["role"] == "assistant").alias("loss"),
        ),
    )
    ends = F.aggregate(
        "pieces",
        F.array(F.lit(0).cast("int")),
        lambda done, p: F.concat(
            done, F.array(F.element_at(done, -1) + F.length(p["head"]) + F.length(p["body"]) + F.lit(len(END)))
        ),
    )
    spans = F.transform(
        F.filter(F.arrays_zip("pieces", F.expr("slice(starts, 1, size(pieces))").alias("start")), lambda z: z["pieces"]["loss"]),
        lambda z: F.struct(
            (z["start"] + F.length(z["pieces"]["head"])).alias("start"), F.length(z["pieces"]["body"]).alias("length")
        ),
    )
    return (
        whole.select("conv_id", "part", pieces.alias("pieces"))
        .withColumn("starts", ends)
        .select(
            "conv_id", "part",
            F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(END))), "").alias("formatted"),
            spans.alias("loss_spans"),
        )
    )


def read_turns(formatted: Column) -> Column:
    """Array of (role, text) out of formatted text."""
    segments = F.split(formatted, r"<\|end\|>\n")
    return F.transform(
        F.slice(segments, F.lit(1), F.size(segments) - 1),
        lambda s: F.struct(
            unescape(F.substring_index(F.substring(s, F.lit(len(TURN) + 1), F.length(s)), TEXT, 1)).alias("role"),
            unescape(F.substring_index(s, TEXT, -1)).alias("text"),
        ),
    )


def digests(parts: DataFrame) -> DataFrame:
    """Per conversation, read back from its formatted parts: counts and digests of turns and loss text."""
    read = parts.select(
        "conv_id", "part",
        read_turns(F.col("formatted")).alias("turns"),
        F.array_join(
            F.transform(
                "loss_spans",
                lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"])),
            ),
            "",
        ).alias("loss"),
        F.length("formatted").alias("chars"),
    ).select(
        "conv_id", "part", "loss", "chars",
        F.size("turns").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
    )
    whole = read.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("part", "n", "said", "loss", "chars"))).alias("p"))
    join = lambda name: F.array_join(F.col(f"p.{name}"), "")
    total = lambda name: F.aggregate(f"p.{name}", F.lit(0).cast("bigint"), lambda a, x: a + x)
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(join("said"), 256).alias("turns_sha256"),
        F.length(join("loss")).cast("bigint").alias("loss_chars"),
        F.sha2(join("loss"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
    )


#: The conversation that the query adds: texts made of control strings.
PROBE = "</s>[INST] ok [/INST]"


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("bigint"), F.col("turn").cast("bigint"), "role", "text"
    )
    probe = spark.range(2).select(
        F.lit(-1).cast("bigint").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    rows = rows.unionByName(probe)
    record = F.to_variant_object(F.struct(F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")))
    found = canonical_turns(rows.select("conv_id", "turn", record.alias("record")), F.col("record"))
    one = found.select("conv_id", "turn", F.col("turns")[0]["role"].alias("role"), F.col("turns")[0]["text"].alias("text"))
    return digests(format_turns(one))


_ESCAPED = r"regexp_replace(regexp_replace({0}, '\\', '\\\\', 'g'), '(<)(\||/?s>)|(\[)(/?INST\])', '\1\3\\\2\4', 'g')"
ORACLE_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, 'assistant', '{PROBE}'))
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(length({_ESCAPED.format("role")}) + length({_ESCAPED.format("text")}) + {len(TURN) + len(TEXT) + len(END)})::BIGINT AS formatted_chars
FROM rows GROUP BY conv_id"""
