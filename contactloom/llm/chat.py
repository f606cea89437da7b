"""Chat formatting: records of differing layouts become canonical turns, then template text.

The nested field paths of a record (names and nesting, no scalar types) are hashed; the fingerprint picks
a declarative layout that says where role and text stand.  A record with an unknown fingerprint is
returned with layout ``unknown`` and no turns, not dropped.

The template marks every turn as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside texts a backslash is
doubled and a control string gets one after its first character, so a text never contains a mark and
"drop a backslash, keep what follows" restores it.  Roles are URL-encoded.

Defined cases: a null text or role is empty; turns with equal numbers are ordered by role, then text; a
null turn number sorts first; rows with a null conversation id form one conversation; repeated rows stay
repeated turns; further columns are not read; an empty table gives none.  A conversation is one row of
the output, so its own length bounds what a task holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from contactloom.llm.common import LONGEST

START, END = "<|im_start|>", "<|im_end|>"

# Strings that public chat templates treat as control marks; "<|" covers all <|...|> marks.
CONTROL = ["<|", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>"]

TURNS = "array<struct<role:string,text:string>>"

#: name -> (field paths, how to read the turns).  ``list`` names the list, the role key and the text key;
#: ``fields`` names the role and the path of each single turn.
LAYOUTS: dict[str, dict] = {
    "messages": {"list": ("messages", "role", "content")},
    "conversations": {"list": ("conversations", "from", "value")},
    "prompt_response": {"fields": [("user", "prompt"), ("assistant", "response")]},
    "instruction_output": {"fields": [("user", "instruction"), ("assistant", "output")]},
    "system_prompt": {"fields": [("system", "system"), ("user", "prompt"), ("assistant", "response")]},
}

#: Role names of some layouts and their canonical form.
ROLES = {"conversations": {"human": "user", "gpt": "assistant"}}


def field_paths(record: Column) -> Column:
    """Canonical text of a VARIANT's nested field names: its schema without scalar types."""
    return F.regexp_replace(
        F.schema_of_variant(record), r"\b(?:STRING|BIGINT|DOUBLE|BOOLEAN|VOID|VARIANT|DATE|TIMESTAMP\w*|DECIMAL\(\d+,\s*\d+\))", "*"
    )


def _declared_paths(layout: dict) -> str:
    if "list" in layout:
        name, role, text = layout["list"]
        keys = ", ".join(f"{k}: *" for k in sorted((role, text)))
        return f"OBJECT<{name}: ARRAY<OBJECT<{keys}>>>"
    return "OBJECT<" + ", ".join(f"{p}: *" for p in sorted(p for _, p in layout["fields"])) + ">"


def fingerprint(record: Column) -> Column:
    return F.xxhash64(field_paths(record))


def _read(layout: str, record: Column) -> Column:
    spec = LAYOUTS[layout]
    if "list" in spec:
        name, role, text = spec["list"]
        rows = F.try_variant_get(record, f"$.{name}", f"array<struct<`{role}`:string,`{text}`:string>>")
        names = ROLES.get(layout, {})

        def canonical(r: Column) -> Column:
            out = r
            for other, own in names.items():
                out = F.when(r == other, F.lit(own)).otherwise(out)
            return out

        return F.transform(
            rows,
            lambda x: F.struct(
                F.coalesce(canonical(x[role]), F.lit("")).alias("role"), F.coalesce(x[text], F.lit("")).alias("text")
            ),
        )
    return F.array(*[
        F.struct(
            F.lit(role).alias("role"),
            F.coalesce(F.try_variant_get(record, f"$.{path}", "string"), F.lit("")).alias("text"),
        )
        for role, path in spec["fields"]
    ])


def canonical_turns(records: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Adds ``layout`` and ``turns`` to rows whose ``raw_col`` holds JSON text."""
    parsed = records.withColumn("_record", F.try_parse_json(raw_col))
    marked = parsed.withColumn("_print", fingerprint(F.col("_record")))
    layout, turns = F.lit("unknown"), F.lit(None).cast(TURNS)
    for name, spec in reversed(LAYOUTS.items()):
        hit = F.col("_print") == F.xxhash64(F.lit(_declared_paths(spec)))
        layout = F.when(hit, F.lit(name)).otherwise(layout)
        turns = F.when(hit, _read(name, F.col("_record")).cast(TURNS)).otherwise(turns)
    return marked.withColumns({"layout": layout, "turns": turns}).drop("_record", "_print")


def escape(text: Column) -> Column:
    out = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    for mark in CONTROL:
        out = F.replace(out, F.lit(mark), F.lit(mark[0] + "\\" + mark[1:]))
    return out


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_turns(chats: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """Adds ``formatted`` and ``loss_spans``: code points [start, end) of what the loss is taken on."""
    parts = F.transform(
        "turns",
        lambda t: F.struct(
            F.concat(F.lit(START), F.url_encode(t["role"]), F.lit("\n")).alias("head"),
            escape(t["text"]).alias("body"),
            (t["role"] == loss_role).alias("loss"),
        ),
    )
    tail = F.lit(END + "\n")
    cut = chats.withColumn("_parts", parts)
    sizes = F.transform("_parts", lambda p: F.length(p["head"]) + F.length(p["body"]) + F.length(tail))
    placed = cut.withColumn("_sizes", sizes)
    spans = F.transform(
        "_parts",
        lambda p, i: F.struct(
            (F.aggregate(F.slice("_sizes", 1, i), F.lit(0), lambda a, x: a + x) + F.length(p["head"])).alias("start"),
            (F.aggregate(F.slice("_sizes", 1, i), F.lit(0), lambda a, x: a + x) + F.length(p["head"]) + F.length(p["body"])).alias("end"),
            p["loss"].alias("loss"),
        ),
    )
    return placed.withColumns({
        "formatted": F.array_join(F.transform("_parts", lambda p: F.concat(p["head"], p["body"], tail)), ""),
        "loss_spans": F.transform(F.filter(spans, lambda s: s["loss"]), lambda s: F.struct(s["start"], s["end"])),
    }).drop("_parts", "_sizes")


def read_back(formatted: DataFrame) -> DataFrame:
    """Adds ``read_turns`` and ``loss_text``, taken from the template text and its loss spans alone."""
    pieces = F.slice(F.split("formatted", START.replace("|", r"\|")), 2, LONGEST)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, "\n", 1)
        body = F.substring(piece, F.length(head) + 2, F.length(piece) - F.length(head) - F.lit(1 + len(END) + 1))
        return F.struct(F.url_decode(head).alias("role"), unescape(body).alias("text"))

    lost = F.transform(
        "loss_spans", lambda s: unescape(F.substring("formatted", s["start"] + 1, s["end"] - s["start"]))
    )
    return formatted.withColumns({"read_turns": F.transform(pieces, turn), "loss_text": F.array_join(lost, "")})


def records(conversations: DataFrame) -> DataFrame:
    """(conv_id, raw): the rows of a conversation as one JSON record, in a layout that suits its turns.

    A prompt with its response takes the two-field layout, known roles the from/value list, all other
    conversations the role/content list.
    """
    turn = F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    rows = conversations.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("t"))
    roles = F.transform("t", lambda x: x["role"])
    pair = F.to_json(F.struct(F.get("t", F.lit(0))["text"].alias("prompt"), F.get("t", F.lit(1))["text"].alias("response")))
    other = F.create_map(*[F.lit(x) for x in ("user", "human", "assistant", "gpt", "system", "system")])
    exchanged = F.to_json(F.struct(
        F.transform("t", lambda x: F.struct(F.element_at(other, x["role"]).alias("from"), x["text"].alias("value"))).alias("conversations")
    ))
    plain = F.to_json(F.struct(
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages")
    ))
    known = F.forall(roles, lambda r: r.isin("user", "assistant", "system"))
    raw = (
        F.when(roles == F.array(F.lit("user"), F.lit("assistant")), pair)
        .when(known & (F.get(roles, F.lit(0)) == "system"), exchanged)
        .otherwise(plain)
    )
    return rows.select("conv_id", raw.alias("raw"))


def format_chats(chats: DataFrame, raw_col: str = "raw") -> DataFrame:
    """Records to template text with loss spans, read back once."""
    return read_back(format_turns(canonical_turns(chats, raw_col)))
