"""Transcript parsing: a hidden Markov model over lines recovers who speaks.

Hidden states are the roles, each as first line of a turn or as further
line. A line is observed through its speaker marker (none, or one that names
a role), a blank line before it, its length class and a closing question
mark. Start, transition and emission probabilities are counted from labelled
turns by Spark; Viterbi finds the roles of a transcript's lines, and
turns are rendered in one canonical form.

Transcripts come as ordered parts and are streamed in order. The search is
exact and online: lines are given out as soon as the best paths of all states
agree on them, so memory does not grow with the transcript.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.shared import map_batches

ROLES = ("system", "user", "assistant")
STATES = [(role, first) for role in ROLES for first in (True, False)]
# Words that name a speaker in front of a line.
SPEAKERS = {
    "system": ("system", "instruction", "instructions"),
    "user": ("user", "human", "customer", "question", "q", "prompter"),
    "assistant": ("assistant", "ai", "bot", "chatbot", "answer", "a", "model", "agent"),
}
_CLASS = {word: 1 + i for i, role in enumerate(ROLES) for word in SPEAKERS[role]}
_MARKER = re.compile(r"\s*(?:[#>*\[<|]+\s*)?(%s)\s*(?:[\]>|*]+\s*:?|:\s*\**|(?=$))\s*"
                     % "|".join(sorted(_CLASS, key=len, reverse=True)), re.I)
_BARE = re.compile(r"\s*(?:q|a)\s*$", re.I)
FEATURES = {"marker": 4, "blank": 2, "length": 4, "question": 2}
SMOOTHING = 0.5
TRACE_EVERY = 256


def observe(line: str, blank: bool) -> tuple[tuple[int, int, int, int], str]:
    """Feature values of one line and the line without its marker."""
    found = _MARKER.match(line)
    if found and (_BARE.match(line) or found.group(0).strip().lower() == found.group(1).lower() != line.strip().lower()):
        found = None
    marker = _CLASS[found.group(1).lower()] if found else 0
    rest = line[found.end():] if found else line
    size = len(rest)
    return (marker, int(blank), 0 if not size else 1 if size < 60 else 2 if size < 300 else 3,
            int(rest.rstrip().endswith("?"))), rest


def _lines(text: str, joined: bool) -> Iterator[tuple[str, bool]]:
    """Lines with a letter or sign in them and whether a blank line (or a new part) comes before."""
    blank = joined
    for line in text.split("\n"):
        if line.strip():
            yield line, blank
            blank = False
        else:
            blank = True


def _emissions(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        count: dict[tuple[str, int, int], int] = {}
        for role, text, first_part in zip(b["role"], b["text"], b["first_part"]):
            if role not in ROLES:
                continue
            n = 0
            for n, (line, blank) in enumerate(_lines(text, not first_part), 1):
                state = STATES.index((role, n == 1))
                for kind, value in zip(FEATURES, observe(line, blank)[0]):
                    count[kind, state, value] = count.get((kind, state, value), 0) + 1
            count["more", ROLES.index(role), 1] = count.get(("more", ROLES.index(role), 1), 0) + max(0, n - 1)
            count["more", ROLES.index(role), 0] = count.get(("more", ROLES.index(role), 0), 0) + 1
        yield pd.DataFrame([(*k, v) for k, v in count.items()], columns=["kind", "a", "b", "n"])


def learn(turns: DataFrame) -> dict[str, np.ndarray]:
    """Log probabilities from ``turns(conv_id, turn, role, text)``, text with its marker.

    Counts cover all rows and are aggregated by Spark; only the count table
    (states times feature values) reaches the driver. Rows with a null or
    unknown role or a null text are left out; no rows give a uniform model.
    """
    clean = turns.select("conv_id", "turn", "role", "text").where(F.col("role").isin(*ROLES) & F.col("text").isNotNull())
    lines = map_batches(clean.select("role", "text", (F.col("turn") == 0).alias("first_part")).fillna({"first_part": False}),
                        _emissions, "kind string, a int, b int, n long")
    counts = lines.groupBy("kind", "a", "b").agg(F.sum("n").alias("n"))
    number = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role")).cast("int") - 1
    order = clean.groupBy("conv_id", "turn").agg(F.min(number).alias("now"))
    after = order.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("now").alias("next"))
    pairs = order.join(after, ["conv_id", "turn"]).groupBy("now", "next").count().selectExpr(
        "'next' kind", "now a", "next b", "count n")
    starts = order.where("turn = 0").groupBy("now").count().selectExpr("'start' kind", "0 a", "now b", "count n")
    found = {(r["kind"], r["a"], r["b"]): r["n"] for r in counts.unionByName(pairs).unionByName(starts).collect()}

    def logs(kind: str, a: int, width: int) -> np.ndarray:
        n = np.array([found.get((kind, a, b), 0) for b in range(width)], float) + SMOOTHING
        return np.log(n / n.sum())

    start = np.full(len(STATES), -math.inf)
    start[::2] = logs("start", 0, len(ROLES))
    move = np.full((len(STATES), len(STATES)), -math.inf)
    for r in range(len(ROLES)):
        stop, more = logs("more", r, 2)
        for s in (2 * r, 2 * r + 1):
            move[s, ::2] = stop + logs("next", r, len(ROLES))
            move[s, 2 * r + 1] = more
    model = {"start": start, "move": move}
    for kind, width in FEATURES.items():
        model[kind] = np.stack([logs(kind, s, width) for s in range(len(STATES))])
    return model


class _Viterbi:
    """Online exact search over one transcript; gives ``(state, line, blank)`` out in order."""

    def __init__(self, model: dict[str, np.ndarray]) -> None:
        self.model, self.score, self.back, self.lines = model, None, [], []

    def step(self, line: str, blank: bool) -> list[tuple[int, str, bool]]:
        seen, rest = observe(line, blank)
        emit = sum(self.model[kind][:, value] for kind, value in zip(FEATURES, seen))
        if self.score is None:
            self.score = self.model["start"] + emit
            self.back.append(np.zeros(len(STATES), np.int8))
        else:
            paths = self.score[:, None] + self.model["move"]
            self.back.append(paths.argmax(axis=0).astype(np.int8))
            self.score = paths.max(axis=0) + emit
            self.score -= self.score.max()
        self.lines.append((rest, blank))
        return self.settled() if len(self.lines) % TRACE_EVERY == 0 else []

    def _give(self, n: int, state: int) -> list[tuple[int, str, bool]]:
        """The first ``n`` lines, the last of them in ``state``."""
        states = []
        for i in range(n - 1, -1, -1):
            states.append(state)
            state = int(self.back[i][state])
        out = [(s, *line) for s, line in zip(reversed(states), self.lines)]
        self.back, self.lines = self.back[n:], self.lines[n:]
        return out

    def settled(self) -> list[tuple[int, str, bool]]:
        alive = {s for s in range(len(STATES)) if self.score[s] > -math.inf}
        for i in range(len(self.lines) - 1, 0, -1):
            alive = {int(self.back[i][s]) for s in alive}
            if len(alive) == 1:
                return self._give(i, alive.pop())
        return []

    def finish(self) -> list[tuple[int, str, bool]]:
        return self._give(len(self.lines), int(self.score.argmax())) if self.lines else []


def _parsed(model: dict[str, np.ndarray]):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, search, turn, said, role = None, None, 0, [], ""
        rows: list[tuple] = []

        def take(found: list[tuple[int, str, bool]]) -> None:
            nonlocal turn, said, role
            for state, line, blank in found:
                speaker, first = STATES[state]
                if first:
                    close()
                    role = speaker
                said.append(("\n\n" if blank and said else "\n" if said else "") + line)

        def close() -> None:
            nonlocal turn, said
            if said:
                rows.append((now[0], turn, role, "".join(said).strip()))
                turn, said = turn + 1, []

        def frame() -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["conv_id", "turn", "role", "text"])
            rows.clear()
            return out.astype({"conv_id": "Int64"})

        for b in batches:
            for key, text in zip(b["conv_id"].astype("Int64"), b["text"]):
                key = None if key is pd.NA else int(key)
                new = now is None or now[0] != key
                if new:
                    if search:
                        take(search.finish())
                        close()
                    now, search, turn = (key,), _Viterbi(model), 0
                for line, blank in _lines(text, not new):
                    take(search.step(line, blank))
            if rows:
                yield frame()
        if search:
            take(search.finish())
            close()
            if rows:
                yield frame()
    return run


def parse(parts: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``(conv_id, turn, role, text, rendered)``: recovered turns of transcripts ``parts(conv_id, part, text)``.

    Parts of a conv_id are read in order of ``part`` (null first; ties by text
    hash), as if parted by a blank line; other columns are ignored. Null and
    blank texts add no line, a conversation without a line has no row, rows
    with a null conv_id form one transcript, repeated rows are lines like any
    others, an empty table gives no rows. Of equally likely paths the first
    state in order system, user, assistant wins. One transcript is one
    sequence, so one task reads it, in order and in bounded memory.
    """
    ordered = (parts.select("conv_id", "part", "text").where("text is not null").withColumn("_h", F.xxhash64("text"))
               .repartition("conv_id").sortWithinPartitions("conv_id", "part", "_h").select("conv_id", "text"))
    turns = map_batches(ordered, _parsed(model), "conv_id long, turn long, role string, text string")
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>")))


def as_transcript(turns: DataFrame) -> DataFrame:
    """``turns(conv_id, turn, role, text)`` as raw transcript parts, each conversation in one of four marker styles.

    A sixth of the later turns (by checksum) has no marker at all, as in
    copied chats; recovering those is what the model is for. Turns of an
    unknown or null role have none either.
    """
    styles = (("System: ", "User: ", "Assistant: "), ("[System] ", "[Human] ", "[AI] "),
              ("### Instruction\n", "### Question\n", "### Answer\n"), ("**System:** ", "**Customer:** ", "**Agent:** "))
    key = F.coalesce(F.col("conv_id").cast("string"), F.lit(""))
    style = F.crc32(key) % len(styles)
    marker = F.lit("")
    for i, words in enumerate(styles):
        for role, word in zip(ROLES, words):
            marker = F.when((style == i) & (F.col("role") == role), word).otherwise(marker)
    bare = (F.col("turn") > 0) & (F.crc32(F.concat_ws("-", key, F.col("turn").cast("string"))) % 6 == 0)
    return turns.select("conv_id", "turn", "role", F.when(bare, F.col("text"))
                        .otherwise(F.concat(marker, F.col("text"))).alias("text"))


def recovered(turns: DataFrame) -> DataFrame:
    """Turns recovered from raw transcripts of all ``turns``; learned from conversations with crc32(conv_id) mod 3 <> 1."""
    raw = as_transcript(turns)
    taught = raw.where(F.crc32(F.coalesce(F.col("conv_id").cast("string"), F.lit(""))) % 3 != 1)
    return parse(raw.withColumnRenamed("turn", "part"), learn(taught))
