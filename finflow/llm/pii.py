"""Personal data: fixed patterns, and a conditional random field over word shapes.

The patterns give the base spans. A linear-chain conditional random field adds
spans the patterns cannot name (secrets) or miss (numbers written another way).
Its words are runs of non-space characters; its features are word shapes, sizes
and the word before. It is trained on the driver from a small labelled table
(at most ``MOST_LABELLED`` rows are read) and decoded by Viterbi, all runs of
equal length in a batch as one numpy array.

A word without a digit and without ``@`` is never personal data here. Labels of
such words are fixed, so the chain falls apart into the runs between them: the
best labels of each run are the best labels of the whole text.

Offsets count code points; ends are exclusive. Found spans that overlap a base
span are left out.

Edge cases. Null and empty texts have no spans. Each row is judged by its own
text, so repeated rows, null ids and ties need no rule; spans that start
together are ordered by kind. Further columns are ignored. Empty tables give no
rows; an empty labelled table finds the base spans only.
"""

from __future__ import annotations

import random
import re
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finflow.llm import words as w
from finflow.llm.store import small_batches

# The kinds in the order of the contract, then those only the model finds.
KINDS = ("email", "ip", "card", "phone", "secret")
MOST_LABELLED = 5_000

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts inside a run of digits, and saying so keeps the search linear.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_TELLING = np.zeros(256, bool)
_TELLING[0x30:0x3A] = _TELLING[0x40] = True

Span = tuple[int, int, int]  # start, kind, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(done, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def _valid(kind: int, found: str) -> bool:
    """The checks of the patterns, for spans the chain adds: a number that fails them is no personal data."""
    digits = "".join(c for c in found if "0" <= c <= "9")
    if KINDS[kind] == "card":
        return 12 <= len(digits) <= 19 and luhn(digits)
    if KINDS[kind] == "phone":
        return 9 <= len(digits) <= 15
    return KINDS[kind] != "ip" or all(int(p[:4] or 0) <= 255 for p in re.split("[^0-9]+", found))


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed patterns, by start, then kind."""
    spans = [(a, 0, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p := part.lstrip("0")) <= 3 and int(p or 0) <= 255 for part in m[0].split(".")):
            spans.append((m.start(), 1, m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            spans.append((m.start(), 2, m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                spans.append((m.start(), 3, m.end()))
    return sorted(spans)


def shape(word: str) -> str:
    """Character classes with runs cut to one: ``Ab-123`` is ``Xx-9``."""
    out = []
    for c in word:
        c = "9" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c
        if not out or out[-1] != c:
            out.append(c)
    return "".join(out)


def features(word: str, before: str) -> list[str]:
    """Names of the features of a word, given the word before it."""
    digits = sum("0" <= c <= "9" for c in word)
    letters = sum(c.isalpha() for c in word)
    form = shape(word)
    bare = word.strip("\"'()[]{}<>,.;:!?")
    return [
        "always",
        f"digits {min(digits, 20) if digits < 4 else 4 * (min(digits, 40) // 4)}",
        f"letters {min(letters, 3) if letters < 4 else 8 * (min(letters, 40) // 8) + 4}",
        f"size {min(len(bare), 40) // 4}",
        f"shape {form[:12]}",
        f"bare {shape(bare)[:12]}",
        f"mixed {len(form) > 6 and letters > 3 and digits > 3}",
        f"signs {''.join(c for c in '@=+/' if c in word)}",
        f"dots {min(word.count('.'), 4)} at {'@' in word}",
        f"before {shape(before.strip(',.;'))[:6]}",
        f"named {re.sub('[^a-z]', '', before.lower()) if len(before) < 12 else ''}",
        f"upper {bare.isupper() and digits > 0 and letters > 5}",
    ]


@dataclass
class Chain:
    """Weights of the features by label, and of neighbouring labels; label 0 is none."""

    index: dict[str, int]
    emit: np.ndarray
    move: np.ndarray

    def scores(self, words: Sequence[Sequence[str]]) -> np.ndarray:
        """Label scores of each word of each sequence (all of one length)."""
        out = np.zeros((len(words), len(words[0]), self.emit.shape[1]))
        for i, sequence in enumerate(words):
            before = ""
            for j, word in enumerate(sequence):
                known = [self.index[f] for f in features(word, before) if f in self.index]
                out[i, j] = self.emit[known].sum(0)
                before = word
        return out

    def decode(self, score: np.ndarray) -> np.ndarray:
        """Best labels by Viterbi: ``score`` is (sequence, word, label)."""
        n, length, labels = score.shape
        best, back = score[:, 0] + self.move[0], np.zeros((n, length, labels), np.int8)
        for t in range(1, length):
            through = best[:, :, None] + self.move[None]
            back[:, t] = through.argmax(1)
            best = through.max(1) + score[:, t]
        last = (best + self.move[:, 0]).argmax(1)
        path = np.zeros((n, length), np.int8)
        for t in range(length - 1, -1, -1):
            path[:, t] = last
            last = back[np.arange(n), t, last]
        return path


def _runs_of(text: str) -> list[list[tuple[int, int]]]:
    """Runs of words that have a digit or ``@``, as word bounds; a run carries the plain word before it first."""
    runs, run, before = [], [], (0, 0)
    for m in _WORD.finditer(text):
        word = m[0]
        if "@" in word or any("0" <= c <= "9" for c in word):
            if not run:
                run = [before]
            run.append(m.span())
        else:
            if run:
                runs.append(run)
                run = []
            before = m.span()
    return [*runs, run] if run else runs


def train_chain(labelled: Sequence[tuple[str, Sequence[Span]]], rounds: int = 120, penalty: float = 0.02) -> Chain:
    """Maximum likelihood with an L2 penalty, by gradient steps with moments (Adam)."""
    sequences = []
    for text, spans in labelled:
        for run in _runs_of(text):
            labels = [0]
            for a, b in run[1:]:
                kinds = [k + 1 for s, k, e in spans if s < b and a < e]
                labels.append(kinds[0] if kinds else 0)
            sequences.append(([text[a:b] for a, b in run], labels))
    count = len(KINDS) + 1
    names: dict[str, int] = {}
    rows, gold = [], []
    for run, labels in sequences:
        row = [[names.setdefault(f, len(names)) for f in features(word, before)] for before, word in zip(run, run[1:], strict=False)]
        rows.append(row)
        gold.append(labels[1:])
    emit, move = np.zeros((len(names), count)), np.zeros((count, count))
    if not rows:
        return Chain(names, emit, move)
    by_length = defaultdict(list)
    for i, row in enumerate(rows):
        by_length[len(row)].append(i)
    batches = []
    for length, members in by_length.items():
        active = np.zeros((len(members), length, len(names)))
        for i, m in enumerate(members):
            for j, f in enumerate(rows[m]):
                active[i, j, f] = 1
        batches.append((active, np.array([gold[m] for m in members])))
    flat = np.zeros(emit.size + move.size)
    first, second = np.zeros_like(flat), np.zeros_like(flat)
    for step in range(1, rounds + 1):
        emit, move = flat[: emit.size].reshape(emit.shape), flat[emit.size :].reshape(move.shape)
        up_emit, up_move = -penalty * emit, -penalty * move
        for active, labels in batches:
            wanted, between = _expected(active @ emit, move, labels)
            up_emit += np.einsum("ntf,ntl->fl", active, wanted)
            up_move += between
        slope = np.concatenate([up_emit.ravel(), up_move.ravel()])
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        flat = flat + 0.1 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    return Chain(names, flat[: emit.size].reshape(emit.shape), flat[emit.size :].reshape(move.shape))


def _expected(score: np.ndarray, move: np.ndarray, gold: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Observed minus expected counts of labels and of label pairs (forward-backward)."""
    n, length, labels = score.shape
    summed = lambda v, axis: (m := v.max(axis, keepdims=True)).squeeze(axis) + np.log(np.exp(v - m).sum(axis))
    ahead, behind = np.zeros_like(score), np.zeros_like(score)
    ahead[:, 0] = score[:, 0] + move[0]
    for t in range(1, length):
        ahead[:, t] = summed(ahead[:, t - 1, :, None] + move, 1) + score[:, t]
    behind[:, -1] = move[:, 0]
    for t in range(length - 2, -1, -1):
        behind[:, t] = summed(move + (score[:, t + 1] + behind[:, t + 1])[:, None, :], 2)
    total = summed(ahead[:, -1] + behind[:, -1], 1)
    share = np.exp(ahead + behind - total[:, None, None])
    observed = np.eye(labels)[gold]
    pairs = np.zeros((labels, labels))
    pairs[0] += observed[:, 0].sum(0) - share[:, 0].sum(0)
    pairs[:, 0] += observed[:, -1].sum(0) - share[:, -1].sum(0)
    for t in range(1, length):
        joint = ahead[:, t - 1, :, None] + move + (score[:, t] + behind[:, t])[:, None, :] - total[:, None, None]
        pairs += np.einsum("ni,nj->ij", observed[:, t - 1], observed[:, t]) - np.exp(joint).sum(0)
    return observed - share, pairs


def chain_spans(texts: Sequence[str], chain: Chain) -> list[list[Span]]:
    """Spans the chain finds in each text; runs of one length are decoded together."""
    by_length = defaultdict(list)
    for i, text in enumerate(texts):
        for run in _runs_of(text):
            by_length[len(run)].append((i, run))
    out: list[list[Span]] = [[] for _ in texts]
    for length, runs in by_length.items():
        size = max(1, 20_000 // length)
        for k in range(0, len(runs), size):
            part = runs[k : k + size]
            words = [[texts[i][a:b] for a, b in run] for i, run in part]
            labels = chain.decode(chain.scores(words)[:, 1:])
            for (i, run), path in zip(part, labels, strict=True):
                out[i] += _joined(texts[i], run[1:], path)
    return out


def _joined(text: str, run: list[tuple[int, int]], labels: np.ndarray) -> list[Span]:
    spans, t = [], 0
    while t < len(run):
        label, end = int(labels[t]), t + 1
        # Only numbers are written over several words.
        while label in (3, 4) and end < len(run) and labels[end] == label:
            end += 1
        if label:
            a, b = run[t][0], run[end - 1][1]
            if label == 5 and "=" in text[a:b]:
                a = text.index("=", a, b) + 1
            while a < b and text[a] in "\"'<[{,.;:!?":
                a += 1
            while b > a and text[b - 1] in "\"'>]}),.;:!?*#$%&|":
                b -= 1
            if a < b and _valid(label - 1, text[a:b]):
                spans.append((a, label - 1, b))
        t = end
    return spans


def all_spans(texts: Sequence[str], chain: Chain) -> list[tuple[list[Span], list[Span]]]:
    """``(base, all)`` spans of each text."""
    out = []
    for text, found in zip(texts, chain_spans(texts, chain), strict=True):
        base = base_spans(text)
        taken = np.zeros(len(text) + 1, bool) if found and base else None
        for start, _, end in base if taken is not None else ():
            taken[start:end] = True
        spans = [f for f in found if taken is None or not taken[f[0] : f[2]].any()]
        out.append((base, sorted(base + spans)))
    return out


def fit_chain(labelled: DataFrame) -> Chain:
    """Train from ``text`` and ``spans``, at most ``MOST_LABELLED`` rows."""
    rows = labelled.select("text", "spans").where("text is not null").limit(MOST_LABELLED).collect()
    table = sorted((r["text"], tuple((s["start"], KINDS.index(s["kind"]), s["end"]) for s in r["spans"] or ())) for r in rows)
    return train_chain(table)


def _telling_texts(batch: pa.RecordBatch) -> tuple[np.ndarray, list[str]]:
    """Rows whose text has a digit or ``@``, and these texts."""
    data, offsets = w.text_column(batch, "text")
    marks = np.append(0, np.cumsum(_TELLING[data]))
    rows = np.flatnonzero(marks[offsets[1:]] > marks[offsets[:-1]])
    return rows, [data[offsets[i] : offsets[i + 1]].tobytes().decode() for i in rows]


def find_personal_data(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``doc_id``, ``base`` and ``spans`` (arrays of kind, start, end) of every row of ``docs``."""
    small_batches(docs.sparkSession)
    chain = fit_chain(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
        as_rows = lambda spans: [{"kind": KINDS[k], "start": a, "end": b} for a, k, b in spans]
        for batch in batches:
            rows, texts = _telling_texts(batch)
            base, spans = [[] for _ in range(batch.num_rows)], [[] for _ in range(batch.num_rows)]
            for i, (b, s) in zip(rows, all_spans(texts, chain), strict=True):
                base[i], spans[i] = as_rows(b), as_rows(s)
            ids = batch.column(batch.schema.get_field_index("doc_id"))
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "base": pa.array(base, kind), "spans": pa.array(spans, kind)})

    span = "array<struct<kind:string,start:bigint,end:bigint>>"
    own = docs.select("doc_id", "text")
    return own.mapInArrow(run, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, base {span}, spans {span}")


def mask_personal_data(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """``docs`` with ``<KIND>`` in the place of each span of ``text``."""
    small_batches(docs.sparkSession)
    chain = fit_chain(labelled)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts = _telling_texts(batch)
            masked = {int(i): _masked(t, s) for i, t, (_, s) in zip(rows, texts, all_spans(texts, chain), strict=True) if s}
            at = batch.schema.get_field_index("text")
            column = _replaced(batch.column(at), masked) if masked else batch.column(at)
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], column, *batch.columns[at + 1 :]], batch.schema.names)

    return docs.mapInArrow(run, docs.schema)


def _replaced(column: pa.Array, rows: dict[int, str]) -> pa.Array:
    """``column`` with some rows exchanged, without touching the others."""
    places = sorted(rows)
    new = pa.array([rows[i] for i in places], column.type)
    take = np.arange(len(column))
    take[places] = len(column) + np.arange(len(places))
    return pa.concat_arrays([column, new]).take(pa.array(take))


def _masked(text: str, spans: Sequence[Span]) -> str:
    out, done = [], 0
    for start, kind, end in spans:
        if start >= done:
            out += [text[done:start], f"<{KINDS[kind].upper()}>"]
        done = max(done, end)
    return "".join([*out, text[done:]])


def written(spans: str) -> Column:
    """``kind:start:end`` of each span, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def labelled_lines(spark: SparkSession, lines: int = 700, seed: int = 7) -> DataFrame:
    """The small labelled table: made-up lines with personal data and with harmless numbers."""
    rng = random.Random(seed)
    some = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    letters, capitals, figures, hexes = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", "0123456789abcdef"
    word = lambda: some(letters, rng.randint(2, 9))
    number = lambda n: some(figures, n)
    octet = lambda: str(rng.randint(0, 255))

    def card() -> str:
        digits = number(15)
        return digits + next(d for d in figures if luhn(digits + d))

    cut = lambda digits, by: by.join(digits[i : i + 4] for i in range(0, 16, 4))
    makers = {
        "email": [
            lambda: f"{word()}.{number(2)}@{word()}{number(1)}.example.com", lambda: f"{word()}@{word()}.org",
            lambda: f"{word()}_{word()}@{word()}.{word()}.net", lambda: f"{word()}@{word()}",
        ],
        "ip": [lambda: ".".join(octet() for _ in range(4))],
        "card": [card, lambda: cut(card(), " "), lambda: cut(card(), "-")],
        "phone": [
            lambda: f"+1 ({number(3)}) {number(3)}-{number(4)}", lambda: f"+{number(2)} {number(3)} {number(7)}",
            lambda: f"({number(3)}) {number(3)}-{number(4)}", lambda: f"{number(3)}-{number(3)}-{number(4)}",
        ],
        "secret": [
            lambda: f"AKIA{''.join(rng.choice(capitals + figures) for _ in range(14))}{number(2)}",
            lambda: f'"{some(hexes, 40)}"', lambda: f"password={some(hexes, 18)}", lambda: f"key={some(hexes, 32)}",
            lambda: f"sk-{some(letters + figures, 24)}{number(1)}",
        ],
        None: [
            lambda: str(rng.randint(1, 2100)), lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 99)}", lambda: f"{number(1)}.{number(1)}.",
            lambda: f"v{number(1)}.{number(2)}.{number(1)}", lambda: f"{rng.randint(1, 12)}:{number(2)}", lambda: f"${number(2)},{number(3)}.00",
            lambda: f"{number(4)}-{number(2)}-{number(2)}", lambda: f"{rng.randint(1, 100)}%", lambda: f"[{number(2)}]", lambda: f"{word()}{number(1)}",
            lambda: f"{number(3)},{number(3)},{number(3)}", lambda: f"{number(2)}/{number(2)}/{number(4)}", lambda: f"{rng.randint(1, 9)}th",
            lambda: f"({number(4)})", lambda: f"{number(1)})", lambda: f"{capitals[rng.randrange(26)]}{number(2)}", lambda: f"pp. {number(2)}-{number(3)}",
            lambda: f"{number(2)}***", lambda: f"x={number(2)}", lambda: "@" + word(), lambda: f"{number(7)}", lambda: f"#{number(4)}",
        ],
    }
    lead = {"secret": ["token =", "and", ""], "phone": ["call", ""], "card": ["card", ""], "ip": ["from", ""], "email": ["mail", ""]}
    rows, kinds = [], list(makers)
    for _ in range(lines):
        text, spans = word(), []
        for _ in range(rng.randint(1, 3)):
            kind = rng.choice([*kinds, None, None])
            text += "".join(f" {word()}" for _ in range(rng.randint(0, 3)))
            text += f" {rng.choice(lead[kind])}".rstrip() if kind else ""
            value = rng.choice(makers[kind])()
            if kind:
                spans.append((kind, len(text) + 1, len(text) + 1 + len(value)))
            text += f" {value}{rng.choice(['', '', '', '.', ','])}"
        rows.append((f"{text} {word()}.", spans))
    return spark.createDataFrame(rows, "text string, spans array<struct<kind:string,start:bigint,end:bigint>>")
