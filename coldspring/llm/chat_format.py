"""Chat transcripts: a hidden Markov model over speaker markers and line features finds who speaks, then turns are rendered.

Lines are range-sorted by conversation and place. The best path through a stretch of lines is a max-plus matrix product, so a
conversation may span many ranges: each range gives the matrices of the stretches at its two ends, the few matrices of
all ranges are chained, and each range is then decoded between the states found at its ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldspring.llm import ordered
from coldspring.workspace import Workspace

# Spellings of speakers in transcripts, by role.
ALIASES = {"system": ["system", "sys", "instructions"], "user": ["user", "human", "q", "customer", "prompter"],
           "assistant": ["assistant", "bot", "a", "ai", "agent"]}
_ROLE_OF = {alias: role for role, names in ALIASES.items() for alias in names}
# "Name:", "[Name]", "### Name:", "<|name|>", "**Name:**"
MARKER = re.compile(r"^\s*(?:#{1,4}\s*([A-Za-z_]{1,20})\s*:|<\|([A-Za-z_]{1,20})\|>|\[([A-Za-z_]{1,20})\]:?|\*\*([A-Za-z_]{1,20}):?\*\*:?|([A-Za-z_]{1,20}):)\s*")
STYLES = [("", ": "), ("### ", ": "), ("<|", "|> "), ("[", "] "), ("**", ":** ")]
LOWEST = -(1 << 63)


@dataclass(frozen=True)
class ChatConfig:
    sample: int = 400           # conversations the model is fitted on, those with the least hash of their id
    sample_lines: int = 50_000  # lines of them at most
    unmarked: int = 8           # of written transcripts, one turn in so many has no marker


def written_transcripts(turns: DataFrame, config: ChatConfig = ChatConfig()) -> DataFrame:
    """(conv_id, turn, line, text, role) of plain transcripts written from (conv_id, turn, role, text): one line per row. The way
    speakers are marked is drawn per conversation by a hash of its id; some turns have a blank line instead of a marker."""
    role = F.coalesce("role", F.lit("other"))
    draw = F.xxhash64("conv_id")
    style = F.pmod(draw, F.lit(len(STYLES)))
    names = F.create_map(*[x for r, a in ALIASES.items() for x in (F.lit(r), F.array(*[F.lit(v) for v in a]))])
    spelled = F.coalesce(F.element_at(names[role], (F.pmod(F.shiftright(draw, 8), F.size(names[role])) + 1).cast("int")), role)
    spelled = F.when(F.pmod(F.shiftright(draw, 20), F.lit(2)) == 0, F.initcap(spelled)).otherwise(spelled)
    marker = F.coalesce(*[F.when(style == i, F.concat(F.lit(a), spelled, F.lit(b))) for i, (a, b) in enumerate(STYLES)])
    bare = (F.pmod(F.xxhash64("conv_id", "turn", F.lit("bare")), F.lit(config.unmarked)) == 0) & (F.col("turn") > 0)
    text = F.coalesce("text", F.lit(""))
    lines = F.split(F.when(bare, F.concat(F.lit("\n"), text)).otherwise(F.concat(marker, text)), "\n")
    return (turns.select("conv_id", "turn", role.alias("role"), bare.alias("bare"), F.posexplode(lines).alias("line", "text"))
            .select("conv_id", "turn", F.col("line").cast("long").alias("line"), "text", "role", "bare"))


def line_marks(lines: list[str]) -> list[tuple[str | None, int, int]]:
    """Per line: the role or name that its marker spells, a class of its number of words, a class of its last character."""
    out = []
    for line in lines:
        found = MARKER.match(line)
        name = next(g for g in found.groups() if g).lower() if found else None
        words = len(line.split())
        last = line.rstrip()[-1:]
        out.append((_ROLE_OF.get(name, name), 0 if not words else 1 if words < 4 else 2 if words < 12 else 3 if words < 40 else 4,
                    0 if not last else 1 if last == "?" else 2 if last in ".!" else 3 if last in ":," else 4))
    return out


def categories(marks: list[tuple[str | None, int, int]], roles: list[str]) -> np.ndarray:
    """Three categories per line: marker (none, unknown, or a role's), words, last character."""
    place = {role: i + 2 for i, role in enumerate(roles)} | {None: 0}
    return np.array([(place.get(name, 1), words, last) for name, words, last in marks], dtype=np.int64).reshape(-1, 3)


def line_features(lines: list[str], roles: list[str]) -> np.ndarray:
    return categories(line_marks(lines), roles)


@dataclass
class Chain:
    """Log probabilities of a hidden Markov model. States of role r: 3 r for a line that opens a turn, 3 r + 1 for its other lines,
    3 r + 2 for a blank line that ends it."""
    roles: list[str]
    first: np.ndarray
    step: np.ndarray
    emit: list[np.ndarray]

    def scores(self, features: np.ndarray) -> np.ndarray:
        return sum(table[:, features[:, k]].T for k, table in enumerate(self.emit))

    def matrix(self, scores: np.ndarray) -> np.ndarray:
        """Best score from each state before the stretch, and in a last row from the start, to each state at its end."""
        out = np.concatenate([self.step, self.first[None]]) + scores[0]
        for row in scores[1:]:
            out = (out[:, :, None] + self.step[None]).max(axis=1) + row
        return out

    def decode(self, scores: np.ndarray, entry: int | None, leave: int | None) -> np.ndarray:
        """The best path, after state ``entry`` (or from the start), ending in ``leave`` (or anywhere). Ties: the lower state."""
        now = (self.first if entry is None else self.step[entry]) + scores[0]
        back = []
        for row in scores[1:]:
            reach = now[:, None] + self.step
            best = reach.argmax(axis=0)
            back.append(best)
            now = reach[best, np.arange(len(now))] + row
        state = int(now.argmax()) if leave is None else leave
        out = [state]
        for best in reversed(back):
            state = int(best[state])
            out.append(state)
        return np.array(out[::-1])


def fit_chain(rows: list[tuple], roles: list[str] | None = None) -> Chain:
    """From (conversation, place, marks of the line, role, kind of line: 0, 1 or 2) in order: counts with one added to each."""
    roles = roles or sorted({r[3] for r in rows}) or ["user"]
    states, sizes = 3 * len(roles), (len(roles) + 2, 5, 5)
    first, step = np.ones(states), np.ones((states, states))
    emit = [np.ones((states, n)) for n in sizes]
    number = {role: i for i, role in enumerate(roles)}
    start = 0
    while start < len(rows):
        end = start
        while end < len(rows) and rows[end][0] == rows[start][0]:
            end += 1
        part = rows[start:end]
        state = np.array([3 * number[r[3]] + r[4] for r in part])
        first[state[0]] += 1
        np.add.at(step, (state[:-1], state[1:]), 1)
        for k, column in enumerate(categories([r[2] for r in part], roles).T):
            np.add.at(emit[k], (state, column), 1)
        start = end
    # a role's other lines follow a line of the same role only
    for r in range(len(roles)):
        first[[3 * r + 1, 3 * r + 2]] = 1e-9
        for kind in (1, 2):
            step[[s for s in range(states) if s // 3 != r], 3 * r + kind] = 1e-9
    return Chain(roles, np.log(first / first.sum()), np.log(step / step.sum(axis=1, keepdims=True)), [np.log(t / t.sum(axis=1, keepdims=True)) for t in emit])


def learn_chain(turns: DataFrame, config: ChatConfig = ChatConfig()) -> Chain:
    """The model fitted on transcripts written from at most ``sample`` conversations of (conv_id, turn, role, text).

    Null conversations are left out, null roles are ``other``, null texts empty lines. Without any line the only role is ``user``."""
    drawn = (turns.select("conv_id").filter("conv_id is not null").distinct().orderBy(F.xxhash64("conv_id"), "conv_id").limit(config.sample))
    part = turns.join(F.broadcast(drawn), "conv_id").filter(F.col("turn") < config.sample_lines // config.sample)
    fields = "conv_id long, turn long, line long, role string, bare boolean, name string, words int, last int"

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name, words, last = zip(*line_marks(batch.column("text").to_pylist())) if batch.num_rows else ((), (), ())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in ("conv_id", "turn", "line", "role", "bare")],
                                              pa.array(name, pa.string()), pa.array(words, pa.int32()), pa.array(last, pa.int32())],
                                             names=[f.split()[0] for f in fields.split(", ")])
    # lines become marks in the tasks, so no text reaches the driver
    lines = (written_transcripts(part, config).withColumn("conv_id", F.col("conv_id").cast("long")).withColumn("turn", F.col("turn").cast("long"))
             .mapInArrow(marks, fields).orderBy("conv_id", "turn", "line", "role", "bare", "name", "words", "last").limit(config.sample_lines).collect())
    rows = []
    for r in lines:
        # the blank line before an unmarked turn still belongs to the turn before
        lead = r["bare"] and r["line"] == 0
        role = rows[-1][3] if lead and rows and rows[-1][0] == r["conv_id"] else r["role"]
        kind = 2 if lead else 0 if r["line"] == (1 if r["bare"] else 0) else 1
        rows.append((r["conv_id"], (r["turn"], r["line"]), (r["name"], r["words"], r["last"]), role, kind))
    return fit_chain(rows)


def _stretches(conv: np.ndarray) -> list[tuple[int, int]]:
    edges = np.append(np.flatnonzero(np.append(True, conv[1:] != conv[:-1])), len(conv)) if len(conv) else np.array([0])
    return [(int(a), int(b)) for a, b in zip(edges[:-1], edges[1:])]


def _sorted(table: pa.Table) -> pa.Table:
    return table.sort_by([(c, "ascending") for c in ("_conv", "_turn", "_line", "_tie")])


def _ends(chain: Chain):
    """For the first and last conversation of a range: the matrix of its lines there."""
    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        conv, lines, number = table.column("_conv").to_numpy(), table.column("_text").to_pylist(), table.column("_range")[0].as_py()
        parts = _stretches(conv)
        out = []
        for a, b in {parts[0], parts[-1]}:
            scores = chain.scores(line_features(lines[a:b], chain.roles))
            out.append((int(conv[a]), number, chain.matrix(scores).tobytes()))
        return pa.table({"_conv": pa.array([o[0] for o in out], pa.int64()), "_range": pa.array([o[1] for o in out], pa.int32()),
                         "_matrix": pa.array([o[2] for o in out], pa.binary())})
    return run


def _borders(chain: Chain, ends: list) -> dict[tuple[int, int], tuple[int | None, int | None]]:
    """(conversation, range) -> (state before, state at the end) for conversations that span ranges."""
    n = 3 * len(chain.roles)
    by_conv: dict[int, list] = {}
    for row in sorted(ends, key=lambda r: (r["_conv"], r["_range"])):
        by_conv.setdefault(row["_conv"], []).append((row["_range"], np.frombuffer(row["_matrix"]).reshape(n + 1, n)))
    out: dict[tuple[int, int], tuple[int | None, int | None]] = {}
    for conv, parts in by_conv.items():
        if len(parts) < 2:
            continue
        now, back = parts[0][1][n], [None]
        for _, matrix in parts[1:]:
            reach = now[:, None] + matrix[:n]
            back.append(reach.argmax(axis=0))
            now = reach.max(axis=0)
        state = int(now.argmax())
        for (number, _), best in zip(reversed(parts), reversed(back)):
            before = None if best is None else int(best[state])
            out[(conv, number)] = (before, state)
            state = before if before is not None else state
    return out


def parse_transcripts(lines: DataFrame, chain: Chain, workspace: Workspace, conv_col: str = "conv_id", order_cols: tuple[str, str] = ("turn", "line"),
                      text_col: str = "text") -> DataFrame:
    """One row (conv_id, place, turn, role, rendered) per line of ``lines``, in place order of each conversation from 0.

    ``rendered`` is the line of the canonical transcript: a line that opens a turn is led by ``<|role|>`` (and closes the turn
    before), its own speaker marker is taken off if it names a role of the chain; the last line closes the transcript. A blank line
    that only ends a turn is no part of it: its ``rendered`` is null. A transcript is the rendered lines that are not null,
    joined by \\n in order of place.

    Lines are ordered by the two order columns, nulls first, ties by text. Null texts are empty lines; lines with a null
    conversation are one conversation. An empty table gives an empty table. Only the named columns are read.
    """
    first, second = order_cols
    low = F.lit(LOWEST)
    rows = lines.select(F.coalesce(F.col(conv_col).cast("long"), low).alias("_conv"), F.coalesce(F.col(first).cast("long"), low).alias("_turn"),
                        F.coalesce(F.col(second).cast("long"), low).alias("_line"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    order = ["_turn", "_line", "_tie"]
    rows = rows.withColumn("_tie", F.md5(F.col("_text").cast("binary")))
    cut = ordered.cut(rows, workspace, ["_conv", *order], "chat-lines")
    ends = cut.groupBy("_range").applyInArrow(_ends(chain), "_conv long, _range int, _matrix binary").collect()
    borders = _borders(chain, ends)

    def run(table: pa.Table) -> pa.Table:
        table = _sorted(table)
        conv, texts, number = table.column("_conv").to_numpy(), table.column("_text").to_pylist(), table.column("_range")[0].as_py()
        role, opens, shown, parts = [], [], [], []
        for a, b in _stretches(conv):
            entry, leave = borders.get((int(conv[a]), number), (None, None))
            features = line_features(texts[a:b], chain.roles)
            state = chain.decode(chain.scores(features), entry, leave)
            # only the name of a role is a marker: "Note: ..." is text
            for s, marker, text in zip(state.tolist(), features[:, 0].tolist(), texts[a:b]):
                role.append(chain.roles[s // 3])
                opens.append(s % 3 == 0)
                parts.append(s % 3 != 2 or bool(text.strip()))
                shown.append(MARKER.sub("", text, count=1) if s % 3 == 0 and marker >= 2 else text)
        return pa.table({c: table.column(c) for c in ("_conv", *order, "_range")} |
                        {"_role": pa.array(role, pa.string()), "_opens": pa.array(opens, pa.bool_()), "_shown": pa.array(shown, pa.string()),
                         "_part": pa.array(parts, pa.bool_())})
    schema = "_conv long, _turn long, _line long, _tie string, _range int, _role string, _opens boolean, _shown string, _part boolean"
    told = workspace.stage(cut.groupBy("_range").applyInArrow(run, schema).withColumn("_one", F.lit(1).cast("long"))
                           .withColumn("_new", F.col("_opens").cast("long")), "chat-decoded")
    placed = ordered.running_sums(told, ["_conv"], order, {"_place": "_one", "_turns": "_new"})
    turn = F.col("_turns") + F.col("_new") - 1
    head = F.when(F.col("_opens"), F.concat(F.when(F.col("_place") > 0, F.lit("<|end|>\n")).otherwise(""), F.lit("<|"), "_role", F.lit("|>\n"))).otherwise("")
    last = F.col("_place") + 1 == F.col("_place_all")
    body = F.when(F.col("_part"), F.concat(head, "_shown", F.when(last, F.lit("\n<|end|>")).otherwise(""))).when(last, F.lit("<|end|>"))
    return placed.select(F.when(F.col("_conv") != LOWEST, F.col("_conv")).alias(conv_col), F.col("_place").alias("place"), F.greatest(turn, F.lit(0)).alias("turn"),
                         F.col("_role").alias("role"), body.alias("rendered"))
