"""Chat formatting: a declarative template, a role automaton, segments with loss flags.

The template says which strings open and close a role's turn and which roles bear loss; the
automaton says which role may follow which. Texts are escaped so that no control string can
appear in them, and `read_back` turns a formatted conversation into its turns again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.registry import query, table


@dataclass(frozen=True)
class Template:
    """Every control string starts with one of `guarded`; `guarded` characters are escaped in texts."""

    begin: str = "<s>"
    # role: (opens a turn, closes it, bears loss)
    roles: dict[str, tuple[str, str, bool]] = field(
        default_factory=lambda: {
            "system": ("<<SYS>>\n", "\n<</SYS>>\n", False),
            "user": ("[INST] ", " [/INST]", False),
            "assistant": ("<out>", "</s>", True),
        }
    )
    # any other role, named in the opening string
    other: tuple[str, str, str] = ("<role ", ">", "</role>")
    escape: str = "\\"
    guarded: str = "\\<>["
    # state: roles that may follow; a conversation is complete in a state of `final`
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {"": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    final: tuple[str, ...] = ("assistant",)

    def escaped(self, text: str) -> str:
        return re.sub(f"([{re.escape(self.guarded)}])", lambda m: self.escape + m[1], text)

    def plain(self, text: str) -> str:
        return re.sub(re.escape(self.escape) + "(.)", r"\1", text, flags=re.DOTALL)

    def turn(self, role: str) -> tuple[str, str, bool]:
        if role in self.roles:
            return self.roles[role]
        return self.other[0] + self.escaped(role) + self.other[1], self.other[2], False

    def pattern(self) -> re.Pattern:
        """One whole turn."""
        body = f"(?:[^{re.escape(self.guarded)}]|{re.escape(self.escape)}.)*"
        ways = [f"{re.escape(a)}(?P<{r}>{body}){re.escape(b)}" for r, (a, b, _) in self.roles.items()]
        ways.append(f"{re.escape(self.other[0])}(?P<_role>{body}){re.escape(self.other[1])}(?P<_text>{body}){re.escape(self.other[2])}")
        return re.compile("|".join(ways), re.DOTALL)

    def read_turn(self, pattern: re.Pattern, formatted: str, at: int = 0) -> tuple[str, str, int]:
        """Role and text of the turn that begins at a place, and where it ends."""
        m = pattern.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        if m["_role"] is not None:
            return self.plain(m["_role"]), self.plain(m["_text"]), m.end()
        role = next(r for r in self.roles if m[r] is not None)
        return role, self.plain(m[role]), m.end()

    def read_back(self, formatted: str) -> list[tuple[str, str]]:
        """Role and text of each turn of a formatted conversation."""
        pattern, at, out = self.pattern(), len(self.begin), []
        while at < len(formatted):
            role, text, at = self.read_turn(pattern, formatted, at)
            out.append((role, text))
        return out


def format_chats(turns: DataFrame, template: Template = Template()) -> DataFrame:
    """Segments of every conversation: conv_id, segment, turn, role, text, loss, valid_so_far.

    Segments of a conversation are contiguous and in order within their partition. Rows are
    ordered by turn, then role and text, nulls first; null role or text is empty; a null
    conv_id is a conversation of its own. Repeated rows are repeated turns. Every conversation
    is formatted; `valid_so_far` turns false at the first role the automaton doesn't allow.
    A conversation streams through its task turn by turn, so its length doesn't count.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        started, conv, state, valid, number = False, None, "", True, 0
        for batch in batches:
            rows: list[tuple] = []
            for c, t, role, text in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "turn", "role", "text"))):
                role = role or ""
                if not started or c != conv:
                    started, conv, state, valid, number = True, c, "", True, 0
                    rows.append((c, number, None, None, template.begin, False, True))
                valid, state = valid and role in template.follows.get(state, ()), role
                opening, closing, loss = template.turn(role)
                for segment, counts in ((opening, False), (template.escaped(text or ""), loss), (closing, False)):
                    number += 1
                    rows.append((c, number, t, role, segment, counts, valid))
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    ids = turns.select("conv_id", "turn").schema
    kinds = {"conv_id": ids["conv_id"].dataType.simpleString(), "turn": ids["turn"].dataType.simpleString()}
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema(
        [
            ("conv_id", to_arrow_type(ids["conv_id"].dataType)), ("segment", pa.int64()),
            ("turn", to_arrow_type(ids["turn"].dataType)), ("role", pa.string()), ("text", pa.string()),
            ("loss", pa.bool_()), ("valid_so_far", pa.bool_()),
        ]
    )
    parts = int(turns.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (
        turns.select("conv_id", "turn", "role", "text")
        .repartition(parts, "conv_id")
        .sortWithinPartitions("conv_id", "turn", "role", "text")
        .mapInArrow(
            run,
            f"conv_id {kinds['conv_id']}, segment long, turn {kinds['turn']}, role string, text string, loss boolean, valid_so_far boolean",
        )
    )


SEGMENTS_PER_TURN = 3


class Digest:
    """What is known of a conversation so far; it is read back one turn at a time."""

    def __init__(self, conv, template: Template, pattern: re.Pattern):
        self.conv, self.template, self.pattern = conv, template, pattern
        self.turns, self.whole, self.loss = 0, hashlib.sha256(), hashlib.sha256()
        self.loss_chars = self.chars = 0
        self.valid, self.role, self.waiting = True, "", []

    def add(self, number: int, text: str, counts: bool, valid: bool) -> None:
        self.chars += len(text)
        self.valid = valid
        if counts:
            plain = self.template.plain(text)
            self.loss.update(plain.encode())
            self.loss_chars += len(plain)
        if number == 0:  # what opens a conversation
            return
        self.waiting.append(text)
        if number % SEGMENTS_PER_TURN == 0:
            piece, self.waiting = "".join(self.waiting), []
            self.role, said, end = self.template.read_turn(self.pattern, piece)
            if end < len(piece):
                raise ValueError(f"more than a turn before {end}")
            self.whole.update(f"{self.role}\n{said}\n".encode())
            self.turns += 1

    def row(self) -> tuple:
        valid = self.valid and self.role in self.template.final
        return self.conv, self.turns, self.whole.hexdigest(), self.loss_chars, self.loss.hexdigest(), self.chars, valid


def digest(segments: DataFrame, template: Template = Template()) -> DataFrame:
    """Per conversation, read back from its formatted text: turns, loss text, length, validity.

    `segments` as `format_chats` gives them. Of a conversation only the turn at hand is kept.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pattern, now = template.pattern(), None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            columns = list(zip(*rows)) or [()] * len(schema)
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

        for batch in batches:
            rows = []
            for c, number, text, counts, valid in zip(
                *(batch.column(k).to_pylist() for k in ("conv_id", "segment", "text", "loss", "valid_so_far"))
            ):
                if number == 0:
                    if now:
                        rows.append(now.row())
                    now = Digest(c, template, pattern)
                now.add(number, text, counts, valid)
            yield out(rows)
        if now:
            yield out([now.row()])

    kind = segments.schema["conv_id"].dataType
    from pyspark.sql.pandas.types import to_arrow_type

    schema = pa.schema(
        [
            ("conv_id", to_arrow_type(kind)), ("n_turns", pa.int64()), ("turns_sha256", pa.string()),
            ("loss_chars", pa.int64()), ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()),
        ]
    )
    return segments.mapInArrow(
        run,
        f"conv_id {kind.simpleString()}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, "
        "formatted_chars long, valid boolean",
    )


CONTROL_TEXT = "</s>[INST] ok [/INST]"

SQL = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), kinds AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, role DESC, text DESC) AS from_end,
    length(regexp_replace(text, '[\\\\<>\\[]', '..', 'g')) + CASE role
      WHEN 'system' THEN 18 WHEN 'user' THEN 15 WHEN 'assistant' THEN 9
      ELSE 14 + length(regexp_replace(role, '[\\\\<>\\[]', '..', 'g')) END AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(3 + sum(chars) AS BIGINT) AS formatted_chars,
  bool_and(CASE coalesce(before, '') WHEN '' THEN role IN ('system', 'user') WHEN 'system' THEN role = 'user'
    WHEN 'user' THEN role = 'assistant' WHEN 'assistant' THEN role = 'user' ELSE false END)
    AND bool_or(from_end = 1 AND role = 'assistant') AS valid
FROM kinds GROUP BY conv_id
"""


@query("op3_chat_format", SQL)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    """All conversations and one whose texts are control strings."""
    given = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(CONTROL_TEXT).alias("text"),
    )
    return digest(format_chats(given.unionByName(own)))
