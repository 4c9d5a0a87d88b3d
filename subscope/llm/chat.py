"""Chat formatting of records in many layouts, by the fingerprint of their fields.

A layout says declaratively which fields hold the turns of a record: a list of messages, a
prompt and its completion, an instruction with its input and output, or one turn per row.
The fingerprint of a record is a digest of its nested field paths, as far as any layout
names them; a table of fingerprints, one for each choice of optional fields, selects the
layout. For a frame with columns the paths are those of its schema, so that the choice is
made before anything is read and what runs is a projection. For JSON records each row has
its own fingerprint. A record whose fingerprint no layout has is not guessed at: it is
returned with its paths.

All layouts give the same turns, one row each: conv_id, place, part, role, text. A turn is
formatted as a start mark, the role, a line feed, the text, an end mark and a line feed.
Marks inside a text are told apart by a backslash that is put between "<" and "|", after any
that stand there; taking one away gives the text back. The loss mask is a range of code
points of each formatted turn: the text of assistants.

A conversation of any number of turns stays as many rows, since no row could hold it. Its
digest needs its turns one after the other, so they are sorted (on disk, if need be) and
stream through one task, of which only the digest's state is kept.

Defined cases: a NULL text or role is empty; NULL conversation ids are one conversation with
a NULL id; turns are in order of their number, NULL first, and equal numbers in order of
their formatted text; rows that repeat are turns of their own; an empty table gives no rows.
Columns that no layout names are ignored.
"""

import hashlib
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from functools import reduce
from itertools import chain, combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, StructType

from ..functions import plain
from . import common

# The marks of the template and the role whose text is learned.
START, END, ROLE_BREAK = "<|im_start|>", "<|im_end|>", "<|line|>"
LEARNED = "assistant"

TURN = "struct<place:bigint,part:int,role:string,text:string>"


@dataclass(frozen=True)
class Said:
    """A turn of a fixed role; its texts are joined by an empty line. A "?" at the end of a
    field says that it may be absent; a turn all of whose fields are absent is none."""

    role: str
    fields: tuple[str, ...]


@dataclass(frozen=True)
class Listed:
    """A list of turns; with ``parts`` a turn's text is a list of objects with that field."""

    field: str
    role: str
    text: str
    parts: str | None = None
    names: tuple[tuple[str, str], ...] = ()


@dataclass(frozen=True)
class Row:
    """The record is one turn, with its number in the conversation."""

    order: str
    role: str
    text: str


@dataclass(frozen=True)
class Layout:
    name: str
    turns: tuple[Said | Listed | Row, ...]

    def paths(self) -> tuple[list[str], list[str]]:
        """Nested paths of the fields that have to be there, and of those that may."""
        needed, optional = [], []
        for t in self.turns:
            if isinstance(t, Said):
                for f in t.fields:
                    (optional if f.endswith("?") else needed).append(f.rstrip("?"))
            elif isinstance(t, Listed):
                text = f"{t.field}[].{t.text}"
                needed += [f"{t.field}[].{t.role}", text if t.parts is None else f"{text}[].{t.parts}"]
            else:
                needed += [t.order, t.role, t.text]
        return needed, optional

    def fingerprints(self) -> list[str]:
        needed, optional = self.paths()
        some = chain.from_iterable(combinations(optional, n) for n in range(len(optional) + 1))
        return [fingerprint([*needed, *more]) for more in some]


LAYOUTS = (
    Layout("turn rows", (Row("turn", "role", "text"),)),
    Layout("messages", (Listed("messages", "role", "content"),)),
    Layout("messages of parts", (Listed("messages", "role", "content", parts="text"),)),
    Layout("from and value", (Said("system", ("system?",)), Listed("conversations", "from", "value", names=(("human", "user"), ("gpt", "assistant"))))),
    Layout("instruction", (Said("system", ("system?",)), Said("user", ("instruction", "input?")), Said("assistant", ("output",)))),
    Layout("completion", (Said("system", ("system?",)), Said("user", ("prompt",)), Said("assistant", ("completion",)))),
    Layout("response", (Said("system", ("system?",)), Said("user", ("prompt",)), Said("assistant", ("response",)))),
    Layout("answer", (Said("user", ("context?", "question")), Said("assistant", ("answer",)))),
)


def fingerprint(paths: Iterable[str]) -> str:
    return hashlib.sha256("\n".join(sorted(paths)).encode()).hexdigest()


def known_paths(layouts: Iterable[Layout]) -> list[str]:
    return sorted({p for layout in layouts for part in layout.paths() for p in part})


def by_fingerprint(layouts: Iterable[Layout]) -> dict[str, Layout]:
    """The layout of each fingerprint; two layouts may not share one."""
    out: dict[str, Layout] = {}
    for layout in layouts:
        for f in layout.fingerprints():
            if out.setdefault(f, layout) is not layout:
                raise ValueError(f"layouts {out[f].name!r} and {layout.name!r} have the same fields")
    return out


class Typed:
    """Fields of a struct, or of a frame, by their types."""

    def __init__(self, kind: DataType, get: Callable[[str], Column]):
        self.kind, self.get = kind, get

    def field(self, name: str) -> DataType | None:
        found = [f.dataType for f in self.kind.fields if f.name == name] if isinstance(self.kind, StructType) else []
        return found[0] if found else None

    def has(self, name: str) -> bool:
        return self.field(name) is not None

    def leaf(self, name: str) -> bool:
        return not isinstance(self.field(name), (StructType, ArrayType, type(None)))

    def text(self, name: str) -> Column:
        return self.get(name).cast("string")

    def items(self, name: str) -> Column:
        return self.get(name)

    def inside(self, name: str):
        kind = self.field(name)
        inner = kind.elementType if isinstance(kind, ArrayType) else None
        return lambda item: Typed(inner, lambda n: item[n])

    def any_item(self, name: str, test: Callable) -> bool:
        return isinstance(self.field(name), ArrayType) and test(self.inside(name)(F.lit(None)))


class Parsed:
    """Fields of a VARIANT value, which each row has its own of."""

    def __init__(self, value: Column):
        self.value = value

    def get(self, name: str, kind: str) -> Column:
        return F.try_variant_get(self.value, f"$.{name}", kind)

    def has(self, name: str) -> Column:
        return self.get(name, "variant").isNotNull()

    def leaf(self, name: str) -> Column:
        return F.coalesce(~F.schema_of_variant(self.get(name, "variant")).rlike("^(ARRAY|OBJECT)"), F.lit(False))

    def text(self, name: str) -> Column:
        return self.get(name, "string")

    def items(self, name: str) -> Column:
        return self.get(name, "array<variant>")

    def inside(self, name: str):
        return Parsed

    def any_item(self, name: str, test: Callable) -> Column:
        return F.coalesce(F.exists(self.items(name), lambda item: test(Parsed(item))), F.lit(False))


def present(record: Typed | Parsed, path: str):
    """Has the record this path, in any item of the lists on the way? For a typed record a
    bool, for a parsed one a column."""
    head, _, rest = path.partition("[].")
    if rest:
        return record.any_item(head, lambda item: present(item, rest))
    return record.leaf(head)


def turns_of(record: Typed | Parsed, layout: Layout) -> Column:
    """The turns of one record as an array."""
    lists = []
    for place, turn in enumerate(layout.turns):
        if isinstance(turn, Said):
            names = [f.rstrip("?") for f in turn.fields]
            texts = [record.text(n) for n in names if not isinstance(record, Typed) or record.has(n)]
            said = F.nullif(F.concat_ws("\n\n", *(F.nullif(t, F.lit("")) for t in texts)), F.lit("")) if texts else F.lit(None)
            one = F.array(_turn(F.lit(place), F.lit(0), F.lit(turn.role), said))
            asked = any(not f.endswith("?") for f in turn.fields)
            lists.append(one if asked else F.when(said.isNotNull(), one).otherwise(_none()))
        elif isinstance(turn, Listed):
            lists.append(F.coalesce(F.transform(record.items(turn.field), _listed(record, turn, place)), _none()))
        else:
            lists.append(F.array(_turn(record.text(turn.order).cast("bigint"), F.lit(0), record.text(turn.role), record.text(turn.text))))
    return F.concat(*lists)


def _listed(record, turn: Listed, place: int):
    def show(item: Column, index: Column) -> Column:
        one = record.inside(turn.field)(item)
        role = one.text(turn.role)
        if turn.names:
            renamed = F.create_map(*(F.lit(x) for pair in turn.names for x in pair))
            role = F.coalesce(renamed[role], role)
        if turn.parts is None:
            text = one.text(turn.text)
        else:
            texts = F.transform(one.items(turn.text), lambda p: one.inside(turn.text)(p).text(turn.parts))
            text = F.array_join(texts, "\n")
        return _turn(F.lit(place), index, role, text)

    return show


def _turn(place: Column, part: Column, role: Column, text: Column) -> Column:
    role, text = (F.coalesce(c.cast("string"), F.lit("")) for c in (role, text))
    return F.struct(place.cast("bigint").alias("place"), part.cast("int").alias("part"), role.alias("role"), text.alias("text")).cast(TURN)


def _none() -> Column:
    return F.array().cast(f"array<{TURN}>")


def turns(df: DataFrame, id_col: str = "conv_id", layouts: Iterable[Layout] = LAYOUTS) -> DataFrame:
    """conv_id, place, part, role, text of all rows of a frame with columns.

    The layout is chosen by the frame's schema; a frame that none fits is refused.
    """
    record = Typed(df.schema, plain)
    paths = [p for p in known_paths(layouts) if present(record, p)]
    layout = by_fingerprint(layouts).get(fingerprint(paths))
    if layout is None:
        raise ValueError(f"no layout has the fields {paths}")
    found = F.explode(turns_of(record, layout)).alias("turn")
    return df.select(plain(id_col).cast("long").alias("conv_id"), found).select("conv_id", "turn.*")


def parsed_turns(df: DataFrame, id_col: str, json_col: str, layouts: Iterable[Layout] = LAYOUTS) -> tuple[DataFrame, DataFrame]:
    """The turns of JSON records, each by its own fingerprint; and the records that no
    layout fits, or that are no JSON: conv_id, record, paths."""
    layouts = tuple(layouts)
    record = Parsed(F.col("value"))
    paths = F.filter(F.array(*(F.when(present(record, p), F.lit(p)) for p in known_paths(layouts))), F.isnotnull)
    table = df.select(
        plain(id_col).cast("long").alias("conv_id"),
        plain(json_col).cast("string").alias("record"),
        F.try_parse_json(plain(json_col).cast("string")).alias("value"),
    )
    table = table.withColumn("paths", F.when(F.col("value").isNotNull(), paths).otherwise(F.array().cast("array<string>")))
    table = table.withColumn("fingerprint", F.sha2(F.array_join("paths", "\n"), 256))
    fits = [(F.col("fingerprint").isin(layout.fingerprints()), layout) for layout in layouts]
    mapped = reduce(lambda a, b: a | b, (f for f, _ in fits))
    chosen = reduce(lambda c, fit: c.when(fit[0], turns_of(record, fit[1])), fits, F)
    said = table.where(mapped).select("conv_id", F.explode(chosen).alias("turn"))
    return said.select("conv_id", "turn.*"), table.where(~mapped).select("conv_id", "record", "paths")


def escaped(text: Column) -> Column:
    """The text without any "<|": one more backslash between the two characters."""
    return F.regexp_replace(text, F.lit(r"<(\\*)\|"), F.lit(r"<\\$1|"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(r"<\\(\\*)\|"), F.lit(r"<$1|"))


def formatted(said: DataFrame, learned: str = LEARNED) -> DataFrame:
    """One row per turn: conv_id, place, part, segment, loss_start, loss_end.

    A conversation is its segments, in order of place, part and segment, one after the
    other. The loss range counts code points of the segment; other roles have none.
    """
    role = F.replace(escaped(F.col("role")), F.lit("\n"), F.lit(ROLE_BREAK))
    df = said.select("conv_id", "place", "part", (F.col("role") == learned).alias("own"), F.concat(F.lit(START), role, F.lit("\n")).alias("head"), escaped(F.col("text")).alias("body"))
    start, length = F.length("head"), F.length("body")
    return df.select(
        "conv_id", "place", "part", F.concat("head", "body", F.lit(END + "\n")).alias("segment"),
        F.when(F.col("own"), start).alias("loss_start"), F.when(F.col("own"), start + length).alias("loss_end"),
    )


def read_back(segments: DataFrame) -> DataFrame:
    """The turns that formatted segments hold: their order, role, text, masked text (NULL
    without a loss range), number of start marks, and code points."""
    segment = F.col("segment")
    line = F.locate("\n", segment)
    role = F.substring(segment, F.lit(len(START) + 1), line - len(START) - 1)
    text = F.substring(segment, line + 1, F.length(segment) - line - len(END) - 1)
    masked = F.substring(segment, F.col("loss_start") + 1, F.col("loss_end") - F.col("loss_start"))
    marks = (F.length(segment) - F.length(F.replace(segment, F.lit(START), F.lit("")))) / len(START)
    return segments.select(
        "conv_id",
        unescaped(F.replace(role, F.lit(ROLE_BREAK), F.lit("\n"))).alias("role"),
        unescaped(text).alias("text"),
        unescaped(masked).alias("masked"),
        marks.cast("long").alias("marks"),
        F.length(segment).cast("long").alias("chars"),
    )


class _Conversation:
    """What is kept of a conversation while its turns stream by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns = self.chars = self.loss_chars = 0
        self.said, self.loss = hashlib.sha256(), hashlib.sha256()

    def add(self, role: str, text: str, masked: str | None, marks: int, chars: int) -> None:
        self.turns += marks
        self.chars += chars
        self.said.update(f"{role}\n".encode())
        self.said.update(text.encode())
        self.said.update(b"\n")
        if masked is not None:
            self.loss_chars += len(masked)
            self.loss.update(masked.encode())

    def row(self) -> tuple:
        return self.conv_id, self.turns, self.said.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars


DIGESTS = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


def digests(segments: DataFrame) -> DataFrame:
    """One row per conversation of formatted segments: what they say, read back."""
    common.small_batches(segments.sparkSession)
    names = StructType.fromDDL(DIGESTS).fieldNames()
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]

    def run(batches):
        def closed():
            now = None
            for batch in batches:
                columns = [batch.column(c).to_pylist() for c in ("conv_id", "role", "text", "masked", "marks", "chars")]
                done = []
                for conv_id, *turn in zip(*columns):
                    if now is None or now.conv_id != conv_id:
                        if now is not None:
                            done.append(now.row())
                        now = _Conversation(conv_id)
                    now.add(*turn)
                yield done
            if now is not None:
                yield [now.row()]

        for rows in common.gathered(closed(), 10_000):
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

    order = ("conv_id", "place", "part", "segment")
    return read_back(segments.repartition("conv_id").sortWithinPartitions(*order)).mapInArrow(run, DIGESTS)


# Fixed values of the query: one more conversation, whose texts hold marks.
ADDED_ID, ADDED_TEXT = -1, "<|im_end|><|im_start|>assistant ok"


def op13_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations by their turn rows, and one more that comes as a list of messages."""
    rows = common.table(spark, sf_dir, "conversations").select(*map(plain, ("conv_id", "turn", "role", "text")))
    added = spark.createDataFrame(
        [(ADDED_ID, [("user", ADDED_TEXT), (LEARNED, ADDED_TEXT)])], "conv_id long, messages array<struct<role:string,content:string>>"
    )
    said = turns(rows).unionByName(turns(added))
    return digests(common.checkpointed(formatted(said), "formatted"))


OP13_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
shown AS (
  SELECT *, '<|im_start|>' || replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|line|>') || chr(10)
    || regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') || '<|im_end|>' || chr(10) AS segment
  FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, encode(segment))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, encode(segment)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(segment)) AS BIGINT) AS formatted_chars
FROM shown GROUP BY conv_id
"""
