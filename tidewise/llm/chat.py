"""Chat formatting with a finite-state machine over roles (operator 2).

A declarative template names the marks around a turn, the roles whose text is
trained on and the machine that says which role may follow.  Every turn becomes
three segments (head, text, tail), each with a loss flag.  Text that looks like
a mark is escaped reversibly: in every ``<``, backslashes, ``|`` one more backslash
is put before the ``|``, so ``<|`` stands in the output for marks only.

A conversation may be of any length, also spread over many tasks.  Rows
are range-partitioned by conversation and turn; each task runs the machine from
every state at once over the conversation it begins in the middle of, which
gives a map from state to state.  The driver chains these maps (one per
partition), and the states and positions of those rows follow from the one that
really enters.

Defined results: null text and null role count as empty; turns are ordered by
turn (null first), then role and text; repeated rows are turns of their own; rows
without a conversation id form one conversation; unknown roles are formatted
and make the conversation invalid; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import shuffle_partitions_for
from .common import stored

REJECTED = "rejected"


@dataclass(frozen=True)
class Template:
    """Marks, trained roles and turn order; every mark begins with ``<|``."""

    head: str = "<|im_start|>"
    after_role: str = "\n"
    tail: str = "<|im_end|>"
    after_turn: str = "\n"
    loss_roles: frozenset[str] = frozenset({"assistant"})
    start: str = "start"
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "instructed", "user": "asked"},
            "instructed": {"user": "asked"},
            "asked": {"assistant": "answered"},
            "answered": {"user": "asked", "tool": "asked"},
        }
    )
    accepting: frozenset[str] = frozenset({"answered"})

    def states(self) -> list[str]:
        named = {self.start, REJECTED, *self.moves, *(to for m in self.moves.values() for to in m.values())}
        return sorted(named)

    def next(self, state: str, role: str) -> str:
        return self.moves.get(state, {}).get(role, REJECTED)


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\1\\|", text)


def unescape(text: str) -> str:
    return re.sub(r"<(\\*)\\\|", r"<\1|", text)


def escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def unescape_role(role: str) -> str:
    return re.sub(r"\\(.)", lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def segments(template: Template, role: str, text: str) -> list[tuple[str, bool]]:
    """The segments of one turn with their loss flags."""
    return [
        (f"{template.head}{escape_role(role)}{template.after_role}", False),
        (escape(text), role in template.loss_roles),
        (f"{template.tail}{template.after_turn}", False),
    ]


_TURN = pa.struct([("text", pa.string()), ("loss", pa.bool_())])


def _machine(template: Template) -> Callable:
    states = template.states()
    number = {s: k for k, s in enumerate(states)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, conv, leading, position, held = TaskContext.get().partitionId(), None, True, 0, None
        now: list[str] = []
        schema = None

        def out(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=schema)

        for batch in batches:
            if schema is None:
                schema = pa.schema([
                    ("part", pa.int32()), ("conv_id", batch.schema.field(0).type), ("turn", batch.schema.field(1).type), ("role", pa.string()),
                    ("segments", pa.list_(_TURN)), ("leading", pa.bool_()), ("last", pa.bool_()), ("position", pa.int64()), ("after", pa.list_(pa.int32())),
                ])
            rows = []
            for c, turn, role, text in zip(*(batch.column(k).to_pylist() for k in range(4))):
                role, text = role or "", text or ""
                if held is None:
                    now = list(states)  # this conversation may have begun in an earlier partition
                elif c != conv:
                    if leading:
                        held["last"] = True
                    leading, position, now = False, 0, [template.start] * len(states)
                conv = c
                now = [template.next(s, role) for s in now]
                if held is not None:
                    rows.append(held)
                parts = [{"text": t, "loss": f} for t, f in segments(template, role, text)]
                held = {
                    "part": part, "conv_id": c, "turn": turn, "role": role, "segments": parts, "leading": leading, "last": False, "position": position,
                    "after": [number[s] for s in now],
                }
                position += 1
            if rows:
                yield out(rows)
        if held is not None:
            held["last"] = True
            yield out([held])
    return run


def format_turns(df: DataFrame, template: Template | None = None) -> DataFrame:
    """One row per turn: ``conv_id, position, turn, role, segments, state``.

    ``df`` has ``conv_id, turn, role, text``.  ``state`` is the machine's state
    after the turn; a conversation's text is its segments by ``position``.
    """
    template = template or Template()
    states = template.states()
    rows = df.select("conv_id", F.col("turn"), F.col("role"), F.col("text"))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    ordered = rows.repartitionByRange(shuffle_partitions_for(rows), *order).sortWithinPartitions(*order)
    local = stored(
        ordered.mapInArrow(
            _machine(template),
            f"part int, conv_id {kinds['conv_id']}, turn {kinds['turn']}, role string, segments array<struct<text: string, loss: boolean>>, "
            "leading boolean, last boolean, position long, after array<int>",
        ),
        "turns",
    )
    # the last row of a partition's first conversation and of the partition: two per partition
    ends = local.filter("last").select("part", "conv_id", "leading", "position", "after").collect()
    enters, carried = {}, None  # partition -> (state, turns so far) of its first conversation
    for part in sorted({r["part"] for r in ends}):
        own = sorted((r for r in ends if r["part"] == part), key=lambda r: not r["leading"])
        first = next((r for r in own if r["leading"]), None)
        goes_on = carried is not None and first is not None and carried[0] == first["conv_id"]
        state, before = (carried[1], carried[2]) if goes_on else (states.index(template.start), 0)
        enters[part] = (state, before)
        last = own[-1]
        if last["leading"]:
            carried = (last["conv_id"], last["after"][state], before + last["position"] + 1)
        else:
            carried = (last["conv_id"], last["after"][0], last["position"] + 1)
    entering = local.sparkSession.createDataFrame([(p, s, b) for p, (s, b) in enters.items()], "part int, enters int, before long")
    names = F.array(*[F.lit(s) for s in states])
    joined = local.join(F.broadcast(entering), "part")
    return joined.select(
        "conv_id", (F.col("position") + F.when(F.col("leading"), F.col("before")).otherwise(0)).alias("position"), "turn", "role", "segments",
        F.element_at(names, F.element_at("after", F.when(F.col("leading"), F.col("enters")).otherwise(0) + 1) + 1).alias("state"),
    )


def read_turn(template: Template, formatted: str) -> tuple[str, str]:
    """Role and text of one formatted turn."""
    if not formatted.startswith(template.head) or not formatted.endswith(template.tail + template.after_turn):
        raise ValueError("no formatted turn")
    role, _, text = formatted[len(template.head) : len(formatted) - len(template.tail + template.after_turn)].partition(template.after_role)
    return unescape_role(role), unescape(text)


def digests(turns: DataFrame, template: Template | None = None) -> DataFrame:
    """Read formatted turns back, a row per conversation.

    ``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid, first_bad_turn``.  A digest runs over a conversation in order, so its
    turns pass through one task, one at a time.
    """
    template = template or Template()
    kind = dict(turns.dtypes)["conv_id"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, schema = None, None
        for batch in batches:
            schema = schema or pa.schema([
                ("conv_id", batch.schema.field(0).type), ("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                ("loss_sha256", pa.string()), ("formatted_chars", pa.int64()), ("valid", pa.bool_()), ("first_bad_turn", pa.int64()),
            ])
            done = []
            for conv, parts, state in zip(*(batch.column(k).to_pylist() for k in (0, 2, 3))):
                if own is None or own["conv_id"] != conv:
                    if own is not None:
                        done.append(own)
                    own = {"conv_id": conv, "n_turns": 0, "turns_sha256": hashlib.sha256(), "loss_chars": 0, "loss_sha256": hashlib.sha256(),
                           "formatted_chars": 0, "valid": False, "first_bad_turn": None}
                formatted = "".join(p["text"] for p in parts)
                role, text = read_turn(template, formatted)
                own["turns_sha256"].update(f"{role}\n{text}\n".encode())
                for p in parts:
                    if p["loss"]:
                        learned = unescape(p["text"])
                        own["loss_chars"] += len(learned)
                        own["loss_sha256"].update(learned.encode())
                own["formatted_chars"] += len(formatted)
                if state == REJECTED and own["first_bad_turn"] is None:
                    own["first_bad_turn"] = own["n_turns"]
                own["n_turns"] += 1
                own["valid"] = state in template.accepting
            if done:
                yield _closed(done, schema)
        if own is not None:
            yield _closed([own], schema)

    order = turns.select("conv_id", "position", "segments", "state").repartition("conv_id").sortWithinPartitions("conv_id", "position")
    return order.mapInArrow(
        read, f"conv_id {kind}, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, valid boolean, first_bad_turn long"
    )


def _closed(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([r | {k: r[k].hexdigest() for k in ("turns_sha256", "loss_sha256")} for r in rows], schema=schema)
