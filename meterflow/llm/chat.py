"""Chat formatting by schema fingerprint, in SQL functions alone.

A record is a JSON text in one of many layouts. Its fingerprint is a hash of its nested field paths, without
their types; it selects one of the declarative ``MAPPINGS``, whose SQL turns the record into canonical turns of
role and text. Unknown layouts get the name ``unknown`` and no turns. The template then marks every turn; inside
texts a backslash becomes two and ``<|`` gets one in the middle, so that no text can hold a control string and
every text can be read back. The loss mask lists (start, length), counted from 1 in code points of the formatted
text, one entry per assistant turn.

Null or absent texts and roles are empty; an empty message list formats to an empty text; repeated rows and
ties of turn are ordered by role and text; columns other than the four named ones are ignored.

The engine reads no JSON text of some 20 million characters or more. Conversations that may come near keep their
turns out of JSON; a given record that long which does not parse is an error, not an unknown layout.
"""

import hashlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
#: Bytes of JSON up to which a conversation is a JSON record, and from which a record that does not parse is an error.
LARGE = 12_000_000
TURNS = "array<struct<role string, text string>>"


def _listed(path: str, role: str, text: str) -> str:
    return (f"transform(try_variant_get(v, '$.{path}', 'array<struct<`{role}` string, `{text}` string>>'), "
            f"x -> named_struct('role', x.`{role}`, 'text', x.`{text}`))")


def _turn(role: str, path: str) -> str:
    return f"named_struct('role', '{role}', 'text', try_variant_get(v, '$.{path}', 'string'))"


#: Layout name, nested field paths, SQL of the turns. Paths of lists end in [].
MAPPINGS: list[tuple[str, list[str], str]] = [
    ("messages", ["messages[].content", "messages[].role"], _listed("messages", "role", "content")),
    ("numbered messages", ["conv_id", "messages[].content", "messages[].role"], _listed("messages", "role", "content")),
    ("conversations", ["conversations[].from", "conversations[].value"], _listed("conversations", "from", "value")),
    ("dialog", ["dialog[].speaker", "dialog[].utterance"], _listed("dialog", "speaker", "utterance")),
    ("prompt", ["completion", "prompt"], f"array({_turn('user', 'prompt')}, {_turn('assistant', 'completion')})"),
    ("prompt response", ["prompt", "response"], f"array({_turn('user', 'prompt')}, {_turn('assistant', 'response')})"),
    ("system prompt", ["prompt", "response", "system"],
     f"array({_turn('system', 'system')}, {_turn('user', 'prompt')}, {_turn('assistant', 'response')})"),
    ("question", ["answer", "question"], f"array({_turn('user', 'question')}, {_turn('assistant', 'answer')})"),
    ("instruction", ["instruction", "output"], f"array({_turn('user', 'instruction')}, {_turn('assistant', 'output')})"),
    ("instruction input", ["input", "instruction", "output"],
     "array(named_struct('role', 'user', 'text', concat_ws('\\n\\n', try_variant_get(v, '$.instruction', 'string'), "
     f"nullif(try_variant_get(v, '$.input', 'string'), ''))), {_turn('assistant', 'output')})"),
    ("nested prompt", ["request.prompt", "request.system", "response.text"],
     f"array({_turn('system', 'request.system')}, {_turn('user', 'request.prompt')}, {_turn('assistant', 'response.text')})"),
]

#: Names that mean the same speaker, in the layouts that use them.
RENAMED = ("conversations", "dialog")
ROLES = {"human": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant", "prompter": "user"}


def fingerprint_of(paths: list[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def field_paths(record: Column) -> Column:
    """Sorted paths of all leaves of a variant, from its schema: types go, nesting becomes dots and brackets.

    A schema reads ``OBJECT<a: STRING, b: ARRAY<OBJECT<c: STRING>>>``. Its tokens are walked with a stack of
    prefixes; a leaf type gives a path. Field names with characters other than letters, digits, _ and - come
    in backquotes and match no mapping.
    """
    tokens = F.regexp_extract_all(F.schema_of_variant(record), F.lit(r"(OBJECT<|ARRAY<|>|[\w`-]+: |[A-Z]+(?:\([0-9,]+\))?)"), F.lit(1))
    start = F.struct(F.expr("array('')").alias("stack"), F.lit("").alias("now"), F.expr("CAST(array() AS array<string>)").alias("paths"))

    def step(a: Column, t: Column) -> Column:
        stack, now, paths = a["stack"], a["now"], a["paths"]
        up = F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(1)))
        joined = F.when(F.element_at(stack, -1) == "", F.regexp_replace(t, ": $", "")).otherwise(
            F.concat(F.element_at(stack, -1), F.lit("."), F.regexp_replace(t, ": $", "")))

        def state(stack: Column, now: Column, paths: Column) -> Column:
            return F.struct(stack.alias("stack"), now.alias("now"), paths.alias("paths"))

        return (F.when(t == "OBJECT<", state(F.concat(stack, F.array(now)), now, paths))
                .when(t == "ARRAY<", state(F.concat(stack, F.array(F.concat(now, F.lit("[]")))), F.concat(now, F.lit("[]")), paths))
                .when(t == ">", state(up, F.element_at(stack, -1), paths))
                .when(t.endswith(": "), state(stack, joined, paths))
                .otherwise(state(stack, now, F.array_append(paths, now))))

    return F.array_sort(F.aggregate(tokens, start, step)["paths"])


def fingerprint(record: Column) -> Column:
    return F.sha2(F.array_join(field_paths(record), "\n"), 256)


def canonical(records: DataFrame, column: str = "record") -> DataFrame:
    """Adds layout and turns to rows with a JSON text; other columns stay."""
    too_long = F.when(F.octet_length(column) > LARGE, F.raise_error(F.lit("a record is too long to be read as JSON, or is no JSON")).cast("variant"))
    known = F.create_map(*[F.lit(x) for name, paths, _ in MAPPINGS for x in (fingerprint_of(paths), name)])
    parsed = records.select(F.struct("*").alias("row"), F.coalesce(F.try_parse_json(column), too_long).alias("v"))
    named = parsed.withColumn("layout", F.coalesce(F.element_at(known, fingerprint(F.col("v"))), F.lit("unknown")))
    turns = reduce(lambda when, m: when.when(F.col("layout") == m[0], F.expr(m[2])), MAPPINGS[1:],
                   F.when(F.col("layout") == MAPPINGS[0][0], F.expr(MAPPINGS[0][2])))
    roles = F.create_map(*[F.lit(x) for pair in ROLES.items() for x in pair])
    clean = F.transform(F.coalesce(turns, F.expr(f"CAST(array() AS {TURNS})")), lambda x: F.struct(
        F.coalesce(F.when(F.col("layout").isin(*RENAMED), F.element_at(roles, x["role"])), x["role"], F.lit("")).alias("role"), F.coalesce(x["text"], F.lit("")).alias("text")))
    return named.select("row.*", "layout", clean.alias("turns"))


def _swap(x: Column, old: str, new: str) -> Column:
    return F.replace(x, F.lit(old), F.lit(new))


def escaped(x: Column) -> Column:
    return _swap(_swap(x, "\\", "\\\\"), "<|", "<\\|")


def escaped_role(x: Column) -> Column:
    return _swap(escaped(x), "\n", "\\n")


def unescaped(x: Column) -> Column:
    """Pairs of backslashes end the reach of one another, so the parts between them are read on their own."""
    return F.array_join(F.transform(F.split(x, r"\\\\"), lambda p: _swap(_swap(p, "\\|", "|"), "\\n", "\n")), "\\")


def formatted(turns: DataFrame) -> DataFrame:
    """Adds formatted and loss_mask to rows with turns."""
    parts = F.transform("turns", lambda x: F.struct(
        (x["role"] == "assistant").alias("loss"), F.concat(F.lit(OPEN), escaped_role(x["role"]), F.lit("\n")).alias("head"),
        escaped(x["text"]).alias("body")))
    start = F.struct(F.lit(1).cast("long").alias("at"), F.expr("CAST(array() AS array<struct<start:bigint,length:bigint>>)").alias("mask"))

    def step(a: Column, p: Column) -> Column:
        begin, size = a["at"] + F.length(p["head"]), F.length(p["body"]).cast("long")
        own = F.array(F.struct(begin.alias("start"), size.alias("length")))
        return F.struct((begin + size + len(CLOSE)).alias("at"), F.when(p["loss"], F.concat(a["mask"], own)).otherwise(a["mask"]).alias("mask"))

    text = F.array_join(F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "")
    return turns.select(F.struct("*").alias("row"), parts.alias("parts")).select(
        "row.*", text.alias("formatted"), F.aggregate("parts", start, step)["mask"].alias("loss_mask"))


def read_back(formatted_text: Column) -> Column:
    """The turns of a formatted text."""
    def turn(part: Column) -> Column:
        cut = F.instr(part, "\n")
        body = F.substr(part, cut + 1, F.greatest(F.length(part) - cut - len(CLOSE), F.lit(0)))
        return F.struct(unescaped(F.substr(part, F.lit(1), cut - 1)).alias("role"), unescaped(body).alias("text"))

    pieces = F.split(formatted_text, r"<\|im_start\|>")
    return F.transform(F.slice(pieces, F.lit(2), F.size(pieces)), turn)


def loss_text(formatted_text: Column, mask: Column) -> Column:
    return F.array_join(F.transform(mask, lambda m: unescaped(F.substr(formatted_text, m["start"].cast("int"), m["length"].cast("int")))), "")


def records(conversations: DataFrame) -> DataFrame:
    """conv_id and a JSON record of the messages in order of turn, one row per conversation; large has those beyond JSON."""
    message = F.struct(F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("content"))
    # a byte takes at most six in JSON
    size = F.sum(6 * (F.octet_length("m.role").cast("long") + F.octet_length("m.content")) + 64)
    grouped = conversations.select("conv_id", message.alias("m")).groupBy("conv_id").agg(
        F.array_sort(F.collect_list("m")).alias("m"), size.alias("size"))
    plain = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("content")))
    turns = F.transform("m", lambda x: F.struct(x["role"].alias("role"), x["content"].alias("text")))
    return grouped.select("conv_id", F.when(F.col("size") < LARGE, F.to_json(F.struct(plain.alias("messages")))).alias("record"),
                          F.when(F.col("size") >= LARGE, turns).alias("large"))


def format_conversations(conversations: DataFrame) -> DataFrame:
    """conv_id, layout, turns, formatted, loss_mask."""
    read = canonical(records(conversations))
    whole = read.select("conv_id", F.when(F.col("large").isNull(), F.col("layout")).otherwise("messages").alias("layout"),
                        F.coalesce("large", "turns").alias("turns"))
    return formatted(whole)
