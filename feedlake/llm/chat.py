"""Chat formatting in DataFrame operations only.

Records come in many layouts: a prompt and a completion, an instruction with an
input, lists of messages, rows by turn. The nested field paths that a record, or
a table, has are hashed; the hash selects a declarative mapping to canonical
turns (conversation, turn, role, text). A template then writes each
conversation as one text and notes which parts of it are learnt from:

    ### <role>:
    <text>
    </turn>

Inside roles and texts a backslash goes before every ``\\``, ``#`` and ``<`` (in
roles also before ``:`` and line breaks), so no marker can come from a text and
unescaping gives back every text as it was.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import cache
from itertools import combinations

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType
from pyspark.sql.window import Window

from feedlake.plans.handoff import written

OPEN = "### "
BREAK = ":\n"
CLOSE = "\n</turn>\n"
#: Roles whose texts are learnt from.
LEARNT = ("assistant",)
# What public chat layouts call the three roles.
ROLES = {"human": "user", "prompter": "user", "gpt": "assistant", "bot": "assistant", "model": "assistant"}


@dataclass(frozen=True)
class Layout:
    """A record layout: the paths that it has, and where its turns are.

    ``turns`` has (role, path) pairs of texts, in order; a missing or empty text
    gives no turn. A layout with a list has its path in ``messages`` instead, and
    the names of the fields of its elements.
    """

    name: str
    turns: tuple[tuple[str, str], ...] = ()
    messages: str = ""
    role_field: str = "role"
    text_field: str = "content"
    optional: tuple[str, ...] = field(default=())

    def paths(self) -> list[str]:
        if self.messages:
            return [self.messages, f"{self.messages}[0].{self.role_field}"]
        return [p for _, p in self.turns]

    def required(self) -> list[str]:
        return [p for p in self.paths() if p not in self.optional]


_SYSTEM = ("system", "$.system")
#: In order of preference: of the layouts whose required paths a record has, the first one counts.
LAYOUTS = (
    Layout("messages", messages="$.messages"),
    Layout("from_value", messages="$.conversations", role_field="from", text_field="value"),
    Layout("prompt_completion", (_SYSTEM, ("user", "$.prompt"), ("assistant", "$.completion")), optional=("$.system",)),
    Layout("prompt_response", (_SYSTEM, ("user", "$.prompt"), ("assistant", "$.response")), optional=("$.system",)),
    Layout("question_answer", (_SYSTEM, ("user", "$.question"), ("assistant", "$.answer")), optional=("$.system",)),
    Layout("instruction", (("system", "$.instruction"), ("user", "$.input"), ("assistant", "$.output"))),
    Layout("instruction_only", (_SYSTEM, ("user", "$.instruction"), ("assistant", "$.output")), optional=("$.system",)),
)


def known_paths(layouts: tuple[Layout, ...] = LAYOUTS) -> list[str]:
    return sorted({p for layout in layouts for p in layout.paths()})


def fingerprint(paths: Column) -> Column:
    """Hash of a sorted list of field paths."""
    return F.xxhash64(F.array_join(paths, "\n"))


def turns_of_records(
    df: DataFrame, json_col: str, id_col: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS, keep_unmatched: bool = False
) -> DataFrame:
    """Canonical turns ``(conv_id, turn, role, text)`` of a column of JSON records.

    A record's fingerprint is the hash of those paths of all layouts that it
    has, and selects the first layout whose required paths are among them; other
    fields do not matter. Records that are null, no JSON, or of no declared
    layout, an empty list of messages included, give no turns. With
    ``keep_unmatched`` they stay as a row whose ``turn``, ``role`` and ``text``
    are null, and a column ``layout`` tells them from turns. Roles are
    lower-cased and put into the common names.
    """
    found = _fingerprinted(df, json_col, id_col, layouts)
    turns = F.lit(None).cast("array<struct<role:string,text:string>>")
    for layout in layouts:
        turns = F.when(F.col("layout") == layout.name, _mapped(layout)).otherwise(turns)
    rows = found.select("conv_id", "layout", F.posexplode_outer(turns).alias("turn", "t"))
    rows = rows if keep_unmatched else rows.where("turn IS NOT NULL").drop("layout")
    kept = [c for c in rows.columns if c == "layout"]
    return rows.select("conv_id", F.col("turn").cast("long").alias("turn"), "t.role", "t.text", *kept)


def _mapped(layout: Layout) -> Column:
    """The turns of a record ``v`` of this layout."""
    if layout.messages:
        kind = f"array<struct<`{layout.role_field}`:string,`{layout.text_field}`:string>>"
        return F.transform(
            F.try_variant_get("v", layout.messages, kind),
            lambda m: F.struct(
                _common_role(m[layout.role_field]).alias("role"), m[layout.text_field].alias("text")
            ),
        )
    texts = [
        F.struct(F.lit(role).alias("role"), F.try_variant_get("v", path, "string").alias("text"))
        for role, path in layout.turns
    ]
    return F.filter(F.array(*texts), lambda t: F.length(t["text"]) > 0)


def record_layouts(
    df: DataFrame, json_col: str, id_col: str = "conv_id", layouts: tuple[Layout, ...] = LAYOUTS
) -> DataFrame:
    """``(conv_id, fingerprint, layout)`` of each record; the layout is null if none is declared for it."""
    return _fingerprinted(df, json_col, id_col, layouts).select("conv_id", "fingerprint", "layout")


def _fingerprinted(df: DataFrame, json_col: str, id_col: str, layouts: tuple[Layout, ...]) -> DataFrame:
    rows = df.select(F.col(id_col).alias("conv_id"), F.try_parse_json(F.col(json_col)).alias("v"))
    has = [F.when(F.try_variant_get("v", p, "variant").isNotNull(), F.lit(p)) for p in known_paths(layouts)]
    rows = rows.withColumn("paths", F.array_compact(F.array(*has))).withColumn("fingerprint", fingerprint(F.col("paths")))
    # as many rows as there are sets of known paths in the records
    sets = rows.groupBy("fingerprint").agg(F.first("paths").alias("paths"))
    name = F.lit(None).cast("string")
    for layout in reversed(layouts):
        needed = F.array(*map(F.lit, layout.required()))
        name = F.when(F.size(F.array_except(needed, "paths")) == 0, F.lit(layout.name)).otherwise(name)
    mappings = written(sets.select("fingerprint", name.alias("layout")))
    return rows.drop("paths").join(mappings, "fingerprint", "left")


def _common_role(role: Column) -> Column:
    role = F.lower(role)
    for name, common in ROLES.items():
        role = F.when(role == name, common).otherwise(role)
    return role


def schema_paths(schema: StructType, above: str = "") -> list[str]:
    """All nested field paths of a table, sorted; list elements are ``[]``."""
    found = []
    for f in schema.fields:
        path, kind = f"{above}{f.name.lower()}", f.dataType
        while isinstance(kind, ArrayType):
            path, kind = f"{path}[]", kind.elementType
        found += schema_paths(kind, f"{path}.") if isinstance(kind, StructType) else [path]
    return sorted(found)


def _rows_by_turn(df: DataFrame) -> DataFrame:
    return df.select("conv_id", "turn", "role", "text")


def _message_lists(df: DataFrame) -> DataFrame:
    unfolded = df.select("conv_id", F.posexplode("messages").alias("turn", "m"))
    return unfolded.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), _common_role(F.col("m.role")).alias("role"), F.col("m.content").alias("text")
    )


#: Table layouts in order of preference: the paths that must be there, and the mapping.
TABLES: dict[tuple[str, ...], Callable[[DataFrame], DataFrame]] = {
    ("conv_id", "turn", "role", "text"): _rows_by_turn,
    ("conv_id", "messages[].role", "messages[].content"): _message_lists,
}


def _path_hash(paths: frozenset[str]) -> int:
    """What :func:`fingerprint` is for columns."""
    unsigned = xxhash.xxh64("\n".join(sorted(paths)), seed=42).intdigest()
    return unsigned - (1 << 64) if unsigned >> 63 else unsigned


@cache
def _table_mappings() -> dict[int, Callable[[DataFrame], DataFrame]]:
    """The mapping of every set of known paths that holds those of a layout, by fingerprint."""
    known = sorted({p for needed in TABLES for p in needed})
    sets = [frozenset(s) for n in range(len(known) + 1) for s in combinations(known, n)]
    fitting = {s: [mapping for needed, mapping in TABLES.items() if s.issuperset(needed)] for s in sets}
    return {_path_hash(s): mappings[0] for s, mappings in fitting.items() if mappings}


def turns_of_table(df: DataFrame) -> DataFrame:
    """Canonical turns of a table whose nested columns, not JSON, have the layout.

    The fingerprint of the table's paths selects the mapping, as that of a
    record does. Rows by turn are taken as they are; a table with ``conv_id``
    and a list ``messages`` of role and content is unfolded. Further columns are
    left out; a table of no declared layout is refused.
    """
    paths = frozenset(schema_paths(df.schema))
    known = frozenset(p for needed in TABLES for p in needed)
    mapping = _table_mappings().get(_path_hash(paths & known))
    if mapping is None:
        raise ValueError(f"no layout is declared for a table with the paths {sorted(paths)}")
    return mapping(df)


def escape(text: Column, role: bool = False) -> Column:
    return F.regexp_replace(text, r"([\\#<:\n])" if role else r"([\\#<])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def format_chats(turns: DataFrame, learnt: tuple[str, ...] = LEARNT) -> DataFrame:
    """One row per conversation: ``conv_id``, ``formatted`` and ``loss_spans``.

    ``loss_spans`` are the places (``start``, ``length``, in code points of
    ``formatted``) of the texts of the ``learnt`` roles, in order. Null roles and
    texts count as empty; turns are ordered by turn (null first), then role and
    text, and repeated rows are turns of their own. Rows without conv_id are one
    conversation. An empty table gives no rows.
    """
    rows = turns.select(
        "conv_id",
        "turn",
        F.coalesce(F.col("role"), F.lit("")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"),
    )
    rows = rows.withColumn("head", F.concat(F.lit(OPEN), escape(F.col("role"), True), F.lit(BREAK)))
    rows = rows.withColumn("body", escape(F.col("text")))
    size = F.length("head") + F.length("body") + len(CLOSE)
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "place": F.row_number().over(order),
            "start": (F.coalesce(F.sum(size).over(before), F.lit(0)) + F.length("head")).cast("int"),
        }
    )
    turn = F.struct(
        "place",
        F.concat("head", "body", F.lit(CLOSE)).alias("piece"),
        "start",
        F.length("body").alias("length"),
        F.col("role").isin(*learnt).alias("learnt"),
    )
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    return chats.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: x["piece"]), "").alias("formatted"),
        F.transform(
            F.filter("t", lambda x: x["learnt"]),
            lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")),
        ).alias("loss_spans"),
    )


def read_chats(chats: DataFrame) -> DataFrame:
    """What :func:`format_chats` wrote, read back: ``conv_id``, ``turns`` (role, text) and ``loss_texts``."""
    pieces = F.split("formatted", CLOSE)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)  # nothing stands after the last mark

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, BREAK, 1)
        return F.struct(
            unescape(F.substr(head, F.lit(len(OPEN) + 1))).alias("role"),
            unescape(F.substr(piece, F.length(head) + len(BREAK) + 1)).alias("text"),
        )

    return chats.select(
        "conv_id",
        F.transform(pieces, turn).alias("turns"),
        F.transform(
            "loss_spans", lambda s: unescape(F.substr(F.col("formatted"), s["start"] + 1, s["length"]))
        ).alias("loss_texts"),
        "formatted",
    )
