"""Chat formatting: records of several layouts become canonical turns, then one training text.

A record's layout is recognised by its fingerprint: a hash of the nested field paths that hold a
value in it. Declarative mappings are keyed by fingerprint and say where roles and texts are; a
field that a mapping calls optional gives it several fingerprints. All steps are built-in SQL
functions.

The template writes each turn as ``<|im_start|>role\\n text <|im_end|>\\n``. Inside roles and texts a
backslash follows every ``<``, ``[`` and backslash, so no control string (``</s>``, ``[INST]``,
``<|im_end|>`` and the like) survives in a text, and dropping those backslashes restores it.

Defined results: null text or role is empty; rows are ordered by turn (nulls first), then role and
text; repeated rows are repeated turns; a null conv_id is a conversation of its own; a record whose
fingerprint no mapping has keeps its row with null turns; extra columns are ignored; an empty
table gives only the records added to it.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

START, END = "<|im_start|>", "<|im_end|>\n"
TURNS = "array<struct<role:string,text:string>>"


@dataclass(frozen=True)
class Mapping:
    """``turns``: list of (role, path) for flat layouts; ``each``: (array, role field, text field) for lists.

    Flat paths of ``optional`` may be missing. ``roles`` renames roles; ``lead``: (role, path) put first.
    """

    name: str
    turns: tuple = ()
    each: tuple = ()
    optional: tuple = ()
    roles: tuple = ()

    def paths(self) -> list[str]:
        return [p for _, p in self.turns] + ([f"{self.each[0]}[].{f}" for f in self.each[1:]] if self.each else [])


#: Layouts known by default.
MAPPINGS = (
    Mapping("messages", turns=(("system", "system"),), each=("messages", "role", "content"), optional=("system",)),
    Mapping("from_value", turns=(("system", "system"),), each=("conversations", "from", "value"), optional=("system",),
            roles=(("human", "user"), ("gpt", "assistant"))),
    Mapping("prompt_response", turns=(("system", "system"), ("user", "prompt"), ("assistant", "response")), optional=("system",)),
    Mapping("instruction", turns=(("user", "instruction"), ("user", "input"), ("assistant", "output")), optional=("input",)),
)


def field_paths(schema: T.StructType, prefix: str = "") -> list[tuple[str, str]]:
    """(path, SQL condition that the path holds a value) for every leaf, lists entered as ``name[]``."""
    out = []
    for f in schema.fields:
        name = f"{prefix}`{f.name}`"
        plain = name.replace("`", "")
        if isinstance(f.dataType, T.StructType):
            out += field_paths(f.dataType, f"{name}.")
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, T.StructType):
            out += [(f"{plain}[].{g.name}", f"exists({name}, x -> x.`{g.name}` IS NOT NULL)") for g in f.dataType.elementType.fields]
        else:
            out.append((plain, f"{name} IS NOT NULL"))
    return sorted(out)


def _hash(paths: Column) -> Column:
    return F.xxhash64(F.array_join(paths, "|"))


def fingerprint(df: DataFrame, ignore: tuple = ()) -> Column:
    """Hash of the sorted nested paths that hold a value in the row."""
    paths = [(p, c) for p, c in field_paths(df.schema) if p not in ignore]
    present = F.array(*[F.when(F.expr(c), F.lit(p)) for p, c in paths])
    return _hash(F.array_compact(present))


def _fingerprints(m: Mapping) -> list[Column]:
    must = [p for p in m.paths() if p not in m.optional]
    subsets = [s for n in range(len(m.optional) + 1) for s in combinations(m.optional, n)]
    return [_hash(F.lit(sorted([*must, *s]))) for s in subsets]


def _turns(m: Mapping, columns: list[str]) -> Column:
    if not set(p.split("[")[0] for p in m.paths() if p not in m.optional) <= set(columns):
        return F.lit(None).cast(TURNS)
    flat = [F.when(F.col(f"`{p}`").isNotNull(), F.struct(F.lit(r).alias("role"), F.col(f"`{p}`").alias("text"))) for r, p in m.turns if p in columns]
    out = F.array_compact(F.array(*flat)) if flat else F.array().cast(TURNS)
    if m.each:
        column, role, text = m.each
        renamed = lambda r: F.coalesce(*[F.when(r == a, F.lit(b)) for a, b in m.roles], r) if m.roles else r
        out = F.concat(out, F.transform(f"`{column}`", lambda x: F.struct(F.coalesce(renamed(x[role]), F.lit("")).alias("role"), F.coalesce(x[text], F.lit("")).alias("text"))))
    return out.cast(TURNS)


def canonical_turns(records: DataFrame, key: str, mappings=MAPPINGS) -> DataFrame:
    """``key``, ``layout`` (the mapping's name or null), ``turns`` (role, text)."""
    body = [c for c in records.columns if c != key]
    df = records.withColumn("__fp", fingerprint(records.select(*[F.col(f"`{c}`") for c in body])))
    layout, turns = F.lit(None).cast("string"), F.lit(None).cast(TURNS)
    for m in reversed(mappings):
        known = F.col("__fp").isin(_fingerprints(m))
        layout, turns = F.when(known, F.lit(m.name)).otherwise(layout), F.when(known, _turns(m, body)).otherwise(turns)
    return df.select(F.col(f"`{key}`").alias(key), layout.alias("layout"), turns.alias("turns"))


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([<\[\\])\\", "$1")


def _role_out(role: Column) -> Column:  # a role ends at the first line break: inside, "<n" stands for one
    return F.replace(escape(role), F.lit("\n"), F.lit("<n"))


def _role_in(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<n"), F.lit("\n")))


_BLOCK = 256


def format_chat(records: DataFrame, key: str, mappings=MAPPINGS) -> DataFrame:
    """``key``, ``layout``, ``formatted`` and ``loss_spans``: (start, stop) in code points of each
    assistant text in ``formatted``, which is what a training loss may see."""
    df = canonical_turns(records, key, mappings)
    df = df.select(key, "layout", F.transform("turns", lambda t: F.struct(
        F.concat(F.lit(START), _role_out(t["role"]), F.lit("\n")).alias("head"), escape(t["text"]).alias("body"),
        (t["role"] == "assistant").alias("loss"))).alias("parts"))
    df = df.select(key, "layout", "parts", F.transform("parts", lambda p: (F.length(p["head"]) + F.length(p["body"]) + len(END)).cast("long")).alias("sizes"))
    # Running sums block by block, so that a long conversation costs no square.
    df = df.select("*", F.expr(f"CASE WHEN size(sizes) > 0 THEN transform(sequence(0, cast((size(sizes) - 1) div {_BLOCK} as int)), b -> "
                               f"aggregate(slice(sizes, b * {_BLOCK} + 1, {_BLOCK}), 0L, (a, x) -> a + x)) ELSE array() END").alias("blocks"))
    df = df.select("*", F.expr("transform(blocks, (x, b) -> aggregate(slice(blocks, 1, b), 0L, (a, y) -> a + y))").alias("before"))
    spans = F.expr(f"transform(parts, (p, i) -> named_struct('loss', p.loss, 'stop', before[cast(i div {_BLOCK} as int)] + "
                   f"aggregate(slice(sizes, cast(i div {_BLOCK} as int) * {_BLOCK} + 1, i % {_BLOCK} + 1), 0L, (a, y) -> a + y) - {len(END)}, 'n', length(p.body)))")
    return df.select(
        key, "layout",
        F.concat_ws("", F.transform("parts", lambda p: F.concat(p["head"], p["body"], F.lit(END)))).alias("formatted"),
        F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct((s["stop"] - s["n"]).alias("start"), s["stop"].alias("stop"))).alias("loss_spans"))


def read_chat(formatted: Column) -> Column:
    """The turns of a formatted text, unescaped: array of (role, text, body), ``body`` as written."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>", -1), lambda p: p != "")
    cut = lambda p: F.locate("\n", p)
    return F.transform(pieces, lambda p: F.struct(
        _role_in(F.substring(p, F.lit(1), cut(p) - 1)).alias("role"),
        unescape(F.substring(p, cut(p) + 1, F.length(p) - cut(p) - len(END))).alias("text"),
        F.substring(p, cut(p) + 1, F.length(p) - cut(p) - len(END)).alias("body")))


def masked_text(formatted: str, spans: str) -> Column:
    """All text of ``formatted`` under the ``spans``, unescaped. Spans are cut out of pieces of the text
    that hold up to _BLOCK of them, so that a long conversation costs no square."""
    numbers = F.when(F.size(spans) > 0, F.sequence(F.lit(0), F.floor((F.size(spans) - 1) / _BLOCK).cast("int"))).otherwise(F.array().cast("array<int>"))
    cut = lambda text, start, stop, base: F.substring(text, (start - base + 1).cast("int"), (stop - start).cast("int"))

    def heard(block):
        base = block[0]["start"]
        pieces = F.array(cut(F.col(formatted), base, F.element_at(block, -1)["stop"], F.lit(0)))
        return F.transform(pieces, lambda piece: F.concat_ws("", F.transform(block, lambda s: unescape(cut(piece, s["start"], s["stop"], base)))))[0]

    return F.concat_ws("", F.transform(F.transform(numbers, lambda b: F.slice(spans, b * _BLOCK + 1, _BLOCK)), heard))


def conversation_records(conversations: DataFrame) -> DataFrame:
    """Rows of turns as one record a conversation, in the layout that its turns fit: prompt and
    response for one exchange, from/value lists where an exchange is led by a system text, else messages."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    said = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("t"))
    said = said.select("conv_id", "t", F.transform("t", lambda x: x["role"]).alias("roles"))
    pair = F.col("roles") == F.array(F.lit("user"), F.lit("assistant"))
    led = (F.element_at("roles", 1) == "system") & F.forall("roles", lambda r: r.isin("system", "user", "assistant"))
    old = F.create_map(F.lit("user"), F.lit("human"), F.lit("assistant"), F.lit("gpt"), F.lit("system"), F.lit("system"))
    return said.select(
        "conv_id",
        F.when(pair, F.col("t")[0]["text"]).alias("prompt"), F.when(pair, F.col("t")[1]["text"]).alias("response"),
        F.when(led, F.transform("t", lambda x: F.struct(old[x["role"]].alias("from"), x["text"].alias("value")))).alias("conversations"),
        F.when(~pair & ~led, F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content")))).alias("messages"))


def chat_digest(conversations: DataFrame) -> DataFrame:
    """Formats every conversation and conversation -1, then reads turns and loss text back from the output."""
    spark = conversations.sparkSession
    sly = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                F.when(F.col("id") == 0, F.lit("user")).otherwise(F.lit("assistant")).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text"))
    rows = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text")
    out = format_chat(conversation_records(rows.unionByName(sly)), "conv_id")
    back = out.select("conv_id", "layout", "formatted", "loss_spans", read_chat(F.col("formatted")).alias("turns"))
    back = back.select("*", masked_text("formatted", "loss_spans").alias("loss_text"))
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return back.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"),
        sha(F.concat_ws("", F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), sha(F.col("loss_text")).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        F.aggregate("loss_spans", F.lit(0).cast("long"), lambda a, s: a + s["stop"] - s["start"]).alias("mask_chars"), "layout")
