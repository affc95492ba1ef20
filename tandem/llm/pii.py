"""Personal data: fixed patterns, and a linear-chain conditional random field over word shapes for what they miss."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tandem.llm.words import small

#: The kinds in the order of reports, and their patterns.
KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# No match can begin inside a run of digits, so the look-behind only saves the attempts.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\x20\x09-\x0D]+")
SUSPECT = re.compile(r"[0-9@]")
EDGE = "\"'.,;:!?<>[]{}"
SPAN = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("base", T.BooleanType())]))
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        n = int(c) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def emails(text: str):
    """As the pattern's leftmost matches, in linear time: the part before each "@" is read backwards."""
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := EMAIL.match(text, start)):
            end = m.end()
            yield start, end
        at = text.find("@", max(at + 1, end))


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) by start, then kind as listed; code points, end exclusive."""
    found = [("email", *span) for span in emails(text)]
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in PHONE.finditer(text):
        if 10 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
            found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def shape(word: str) -> str:
    """Letter case runs, lengths of digit runs, punctuation as it is; numbers also tell whether they pass their check."""
    core = word.rstrip(".,;:!?")
    digits = core.replace("-", "")
    mark = ""
    if 14 <= len(digits) <= 19 and digits.isascii() and digits.isdigit():
        mark = "ok" if luhn(digits) else "no"
    elif IP.fullmatch(core):
        mark = "ok" if all(len(p) <= 3 and int(p) <= 255 for p in core.split(".")) else "no"
    out = re.sub(r"[0-9]+", lambda m: f"<{min(len(m[0]), 20)}>", core)
    out = re.sub(r"[^\W\d_]+", lambda m: "X" if m[0].isupper() else "x" if m[0].islower() else "Xx", out)
    return out[:40] + mark


def rare(shape: str) -> str:
    """What stands for a shape that training has not seen."""
    return "rare@" if "@" in shape else "rare9" if "<" in shape else "rare"


@dataclass
class Model:
    """Weights of the field: current, previous and next shape by label, label bias and transitions. Label 0 is none."""

    shapes: dict[str, int]
    now: np.ndarray
    before: np.ndarray
    after: np.ndarray
    bias: np.ndarray
    moves: np.ndarray
    memo: dict[str, int] = field(default_factory=dict)

    def ids(self, words: list[str]) -> np.ndarray:
        """Shape numbers; 0 is the edge of a text."""
        memo = self.memo
        if len(memo) > 500_000:
            memo.clear()
        out = []
        for w in words:
            if (i := memo.get(w)) is None:
                s = shape(w)
                i = memo[w] = self.shapes.get(s, self.shapes[rare(s)])
            out.append(i)
        return np.array(out, np.int64)

    def scores(self, ids: np.ndarray) -> np.ndarray:
        """Emission of each label at each word of one sequence."""
        out = self.now[ids] + self.bias
        out[1:] += self.before[ids[:-1]]
        out[:1] += self.before[0]
        out[:-1] += self.after[ids[1:]]
        out[-1:] += self.after[0]
        return out

    def decode(self, sequences: list[np.ndarray]) -> list[np.ndarray]:
        """Best labels of each sequence of shape numbers: Viterbi, in batches of equal length.

        A word whose emission favours "none" by more than two moves can ever win back is "none" on the best path, so
        sequences are cut there first; what is left between two such words is short.
        """
        bound = 2 * float(self.moves.max() - self.moves.min())
        labels, pieces = [], {}
        for k, ids in enumerate(sequences):
            labels.append(np.zeros(len(ids), np.int64))
            if not len(ids):
                continue
            score = self.scores(ids)
            open_ = np.flatnonzero(score[:, 0] - score[:, 1:].max(axis=1) <= bound)
            if len(open_):
                for part in np.split(open_, np.flatnonzero(np.diff(open_) > 1) + 1):
                    i, j = int(part[0]), int(part[-1]) + 1
                    own = score[i:j].copy()
                    if i > 0:
                        own[0] += self.moves[0]
                    if j < len(ids):
                        own[-1] += self.moves[:, 0]
                    pieces.setdefault(j - i, []).append((k, i, own))
        for n, group in pieces.items():
            for g in range(0, len(group), 4096):
                part = group[g : g + 4096]
                best = viterbi(np.stack([own for _, _, own in part]), self.moves)
                for (k, i, _), path in zip(part, best, strict=True):
                    labels[k][i : i + n] = path
        return labels


def viterbi(score: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """Best paths for a batch (sequence, position, label); ties go to the smaller label."""
    n, length, _ = score.shape
    best, back = score[:, 0], np.zeros((n, length, score.shape[2]), np.int64)
    for t in range(1, length):
        step = best[:, :, None] + moves
        back[:, t] = step.argmax(axis=1)
        best = step.max(axis=1) + score[:, t]
    path = np.zeros((n, length), np.int64)
    path[:, -1] = best.argmax(axis=1)
    for t in range(length - 1, 0, -1):
        path[:, t - 1] = back[np.arange(n), t, path[:, t]]
    return path


@dataclass(frozen=True)
class Training:
    """Labelled rows are bounded: `rows` texts with personal data and as many without, none over `max_chars`, cut into
    sequences of `length` words."""

    rows: int = 250
    max_chars: int = 4000
    length: int = 30
    steps: int = 60
    rate: float = 0.5
    decay: float = 1e-4
    move_limit: float = 1.0


def labelled(text: str, spans: list[tuple[str, int, int]]) -> tuple[list[str], list[int]]:
    """Words and labels: a word that overlaps a span takes its kind's number, the others 0."""
    words, labels, k = [], [], 0
    spans = sorted(spans, key=lambda s: s[1])
    for m in WORD.finditer(text):
        while k < len(spans) and spans[k][2] <= m.start():
            k += 1
        hit = k < len(spans) and spans[k][1] < m.end()
        words.append(m[0])
        labels.append(1 + KINDS.index(spans[k][0]) if hit else 0)
    return words, labels


def without_code(text: str, spans: list[tuple[str, int, int]]) -> tuple[str, list[tuple[str, int, int]]]:
    """The labelled text with its telephone numbers written without country code, as the patterns can't see them."""
    out, moved, at = [], [], 0
    for kind, start, end in spans:
        if start < at:
            continue
        out.append(text[at:start])
        value = text[start:end]
        if kind == "phone":
            value = re.sub(r"^\+[0-9]+[ .-]+(?=.*[0-9])", "", value) or value
        begin = sum(map(len, out))
        out.append(value)
        moved.append((kind, begin, begin + len(value)))
        at = end
    return "".join([*out, text[at:]]), moved


def train(rows: list[tuple[str, list[tuple[str, int, int]]]], options: Training = Training()) -> Model:
    """Maximum likelihood with a small L2 term, by AdaGrad over the whole labelled table. Without rows all is "none"."""
    sequences = []
    for text, spans in rows:
        words, labels = labelled(text, spans)
        for i in range(0, len(words), options.length):
            sequences.append((words[i : i + options.length], labels[i : i + options.length]))
    counts: dict[str, int] = {}
    for words, _ in sequences:
        for w in words:
            s = shape(w)
            counts[s] = counts.get(s, 0) + 1
    names = ["", "rare", "rare9", "rare@", *sorted(s for s, c in counts.items() if c > 2 and s)]
    n, y = len(names), 1 + len(KINDS)
    model = Model({s: i for i, s in enumerate(names)}, *(np.zeros((n, y)) for _ in range(3)), np.zeros(y), np.zeros((y, y)))
    model.bias[0] = 1.0
    if not sequences:
        return model
    size = max(len(w) for w, _ in sequences)
    ids, gold, mask = np.zeros((len(sequences), size + 2), np.int64), np.zeros((len(sequences), size), np.int64), np.zeros((len(sequences), size))
    for k, (words, labels) in enumerate(sequences):
        ids[k, 1 : len(words) + 1] = model.ids(words)
        gold[k, : len(words)], mask[k, : len(words)] = labels, 1
    weights = [model.now, model.before, model.after, model.bias, model.moves]
    squares = [np.full_like(w, 1e-8) for w in weights]
    truth = np.eye(y)[gold] * mask[:, :, None]
    for _ in range(options.steps):
        emit = model.now[ids[:, 1:-1]] + model.before[ids[:, :-2]] + model.after[ids[:, 2:]] + model.bias
        one, two = expectations(emit, model.moves, mask)
        rest = truth - one
        pairs = np.einsum("kti,ktj->ij", truth[:, :-1], truth[:, 1:]) - two
        flat = rest.reshape(-1, y)
        grads = [np.stack([np.bincount(ids[:, a : a + size].ravel(), flat[:, c], n) for c in range(y)], axis=1) for a in (1, 0, 2)]
        for w, s, g in zip(weights, squares, [*grads, flat.sum(axis=0), pairs], strict=True):
            g = g - options.decay * len(sequences) * w
            s += g * g
            w += options.rate * g / np.sqrt(s)
        np.clip(model.moves, -options.move_limit, options.move_limit, out=model.moves)
    return model


def expectations(emit: np.ndarray, moves: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Label probabilities at each place and expected moves, by forward and backward sums over padded sequences."""
    n, size, y = emit.shape
    e, m = np.exp(emit - emit.max(axis=2, keepdims=True)), np.exp(moves)
    on = mask.astype(bool)
    forward, backward = np.ones((n, size, y)), np.ones((n, size, y))
    forward[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
    for t in range(1, size):
        f = (forward[:, t - 1] @ m) * e[:, t]
        forward[:, t] = np.where(on[:, t, None], f / f.sum(axis=1, keepdims=True), forward[:, t - 1])
    for t in range(size - 2, -1, -1):
        b = (backward[:, t + 1] * e[:, t + 1]) @ m.T
        backward[:, t] = np.where(on[:, t + 1, None], b / b.sum(axis=1, keepdims=True), 1.0)
    one = forward * backward
    one = one / one.sum(axis=2, keepdims=True) * mask[:, :, None]
    two = np.zeros((y, y))
    for t in range(size - 1):
        p = forward[:, t, :, None] * m * (backward[:, t + 1] * e[:, t + 1])[:, None, :]
        two += (p / p.sum(axis=(1, 2), keepdims=True))[on[:, t + 1]].sum(axis=0)
    return one, two


def label_sample(docs: DataFrame, options: Training = Training(), id: str = "doc_id", text: str = "text") -> list[tuple[str, list[tuple[str, int, int]]]]:
    """A small labelled table: texts chosen by the hash of their id, labelled by the patterns, and again with telephone
    numbers that lack their country code. The bounds in `options` hold whatever the size of `docs`."""
    short = docs.where(F.length(text).between(1, options.max_chars)).select(F.col(text).alias("t"), F.xxhash64(F.col(id)).alias("h"))
    rows = []
    for part in (short.where(F.contains("t", F.lit("@"))), short.where(~F.contains("t", F.lit("@")))):
        # The hashes first, so that no task sends more texts than are wanted in all.
        last = part.select("h").orderBy("h").limit(options.rows).agg(F.max("h")).first()[0]
        if last is None:
            continue
        for row in part.where(F.col("h") <= last).orderBy("h", "t").limit(options.rows).collect():
            spans = base_spans(row["t"])
            rows.append((row["t"], spans))
            if any(k == "phone" for k, _, _ in spans):
                rows.append(without_code(row["t"], spans))
    return rows


def added_spans(text: str, words: list[re.Match], labels: np.ndarray, base: list[tuple[str, int, int]]) -> list[tuple[str, int, int]]:
    """Runs of one label, without outer punctuation, that touch no span of the patterns and hold a digit or "@"."""
    out, i = [], 0
    hits = np.flatnonzero(labels)
    while i < len(hits):
        j = i
        while j + 1 < len(hits) and hits[j + 1] == hits[j] + 1 and labels[hits[j + 1]] == labels[hits[i]]:
            j += 1
        start, end = words[hits[i]].start(), words[hits[j]].end()
        while start < end and text[start] in EDGE:
            start += 1
        while end > start and text[end - 1] in EDGE:
            end -= 1
        if start < end and SUSPECT.search(text, start, end) and not any(s < end and start < e for _, s, e in base):
            out.append((KINDS[labels[hits[i]] - 1], start, end))
        i = j + 1
    return out


def find(docs: DataFrame, model: Model, keep: tuple[str, ...], text: str = "text") -> DataFrame:
    """The columns `keep` and `spans`: (kind, start, end, base) of the whole text, by start, then kind as listed.

    Offsets count code points, end exclusive. Spans of the patterns have base = true; the field adds others beside them.
    Null and empty texts have no spans; repeated rows are searched each.
    """
    chosen = docs.select(F.struct(*keep).alias("_kept"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("_text"))
    schema = T.StructType([chosen.schema["_kept"], T.StructField("spans", SPAN)])

    def run(batches):
        for batch in small(batches):
            out, held = [[] for _ in range(batch.num_rows)], []
            for k, raw in enumerate(batch.column("_text").to_pylist()):
                data = np.frombuffer(raw, np.uint8)
                # Every span holds a digit or "@", the added ones by their definition.
                if ((data - np.uint8(48) < 10) | (data == 64)).any():
                    text = raw.decode()
                    words = list(WORD.finditer(text))
                    held.append((k, text, words, base_spans(text)))
            labels = model.decode([model.ids([m[0] for m in words]) for _, _, words, _ in held])
            for (k, text, words, base), found in zip(held, labels, strict=True):
                spans = [(*s, True) for s in base] + [(*s, False) for s in added_spans(text, words, found, base)]
                spans.sort(key=lambda s: (s[1], KINDS.index(s[0])))
                out[k] = [dict(zip(("kind", "start", "end", "base"), s, strict=True)) for s in spans]
            yield pa.RecordBatch.from_arrays([batch.column("_kept"), pa.array(out, SPAN_ARROW)], ["_kept", "spans"])

    return chosen.mapInArrow(run, schema).select("_kept.*", "spans")


def redact(text: str, spans: list) -> str:
    """Each span's kind in angle brackets instead of its characters; overlapping spans are one, named by the first."""
    out, at = [], 0
    for s in spans:
        if s["start"] >= at:
            out += [text[at : s["start"]], f"<{s['kind'].upper()}>"]
        at = max(at, s["end"])
    return "".join([*out, text[at:]])


def redacted(found: DataFrame, text: str = "text") -> DataFrame:
    """Rows of `find` with the text column's spans replaced; `spans` goes. Null texts stay null."""
    schema = found.drop("spans").schema

    def run(batches):
        for batch in small(batches):
            new = [t if not s else redact(t, s) for t, s in zip(batch.column(text).to_pylist(), batch.column("spans").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(new, pa.string()) if n == text else batch.column(n) for n in schema.names], schema.names)

    return found.mapInArrow(run, schema)
