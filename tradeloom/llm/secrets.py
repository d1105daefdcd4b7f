"""Secret scan: fixed patterns, and a character convolutional network for the rest.

Base findings are the matches of three patterns. Candidates are runs of 16 or more key
characters with a digit; every one is scored by a small convolutional network in numpy
over its characters and the text around it, long ones piece by piece. The network learns
from the findings of all documents, equal ones once, labelled 1 where a base finding
overlaps the candidate in any of them; half of the learned examples lose their
surroundings, so that the shape of a key counts by itself. Findings are dealt to shards of
about SHARD_FINDINGS by a hash; every epoch each shard goes on from the mean of all shards'
weights and Adam moments. Scores are calibrated (Platt) on the third of the findings kept
aside, with and without their surroundings, all of them counted by value (floored to
1 / VALUE_STEPS, so the counts are bounded). The threshold lies halfway between the largest
that finds RECALL of those and the next finding of label 0. Candidates beyond it that no
base finding overlaps are added as kind `model`.

A null text is empty and has no findings. Where the documents lack findings of either label
there is no network and base findings stand alone. Repeated rows are scanned alike.
"""

from __future__ import annotations

import hashlib
import io
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradeloom.llm.tables import table, written
from tradeloom.llm.words import replace_texts

#: The patterns of base findings, in order, and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "model")
ASSIGN_LEAST, ACCESS_LEAST = 6, 20
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z+/_-]*[0-9])[A-Za-z0-9+/_-]{16,}={0,2}")
#: Patterns in the syntax of the Arrow kernels that pick the texts to scan; each matches
#: at least where its counterpart does.
PICKS = (
    r"(?i)(password|passwd|secret|token|api_?key)[\"']? *[:=]",
    r"AKIA[A-Z0-9]{16}",
    r"[0-9a-f]{24}",
    r"[A-Za-z0-9+/_-]{16}",
)

#: Findings a shard learns from, about, and the fewest of a label to learn at all.
SHARD_FINDINGS, LEAST_FINDINGS = 4_000, 12
RECALL = 0.98
#: Steps of a value, and its largest size, where findings kept aside are counted.
VALUE_STEPS, VALUE_MOST = 256, 40
PIECE, AROUND = 48, 24
WINDOW = PIECE + 2 * AROUND
#: Character codes: 0 outside the text, 1-128 around a candidate, 129-256 inside.
CODES, EMBEDDED, WIDTH, FILTERS = 257, 8, 5, 16
EPOCHS, BATCH, STEP = 10, 64, 0.01


def base_findings(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all base findings, in order."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def windows(text: str, start: int, end: int) -> np.ndarray:
    """Character codes of a candidate's pieces with what stands around each."""
    rows = []
    for first in range(start, end, PIECE):
        last = min(first + PIECE, end)
        low, high = max(0, first - AROUND), min(len(text), last + AROUND)
        codes = np.minimum(np.array([ord(c) for c in text[low:high]]), 127) + 1
        codes[first - low : last - low] += 128
        row = np.zeros(WINDOW, np.int16)
        at = AROUND - (first - low)
        row[at : at + len(codes)] = codes
        rows.append(row)
    return np.stack(rows)


def join_findings(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end in sorted(found))


def picked(texts: pa.Array) -> list[int]:
    """Rows that can hold a finding or candidate."""
    flags = [pc.match_substring_regex(texts, pattern) for pattern in PICKS]
    any_flag = flags[0]
    for flag in flags[1:]:
        any_flag = pc.or_(any_flag, flag)
    return np.flatnonzero(np.asarray(pc.fill_null(any_flag, False))).tolist()


class Network:
    """Embedding, one convolution, maximum and mean over the places, logistic output."""

    NAMES = ("embedding", "filters", "offset", "output", "bias", "calibration", "threshold")

    def __init__(self, seed: int = 11):
        draw = np.random.default_rng(seed)
        self.embedding = draw.normal(0, 0.3, (CODES, EMBEDDED))
        self.filters = draw.normal(0, 0.2, (WIDTH * EMBEDDED, FILTERS))
        self.offset = np.zeros(FILTERS)
        self.output = draw.normal(0, 0.2, 2 * FILTERS)
        self.bias = np.zeros(1)
        self.calibration = np.array([1.0, 0.0])
        self.threshold = np.array([1.0])

    def forward(self, codes: np.ndarray):
        signs = self.embedding[codes]
        spread = sliding_window_view(signs, WIDTH, axis=1).transpose(0, 1, 3, 2).reshape(len(codes), -1, WIDTH * EMBEDDED)
        raised = np.maximum(spread @ self.filters + self.offset, 0)
        pooled = np.concatenate([raised.max(axis=1), raised.mean(axis=1)], axis=1)
        return spread, raised, pooled, pooled @ self.output + self.bias[0]

    def gradients(self, codes: np.ndarray, labels: np.ndarray) -> dict[str, np.ndarray]:
        spread, raised, pooled, value = self.forward(codes)
        off = (1 / (1 + np.exp(-value)) - labels) / len(labels)
        back = off[:, None] * self.output
        places = raised.shape[1]
        from_places = np.repeat(back[:, None, FILTERS:] / places, places, axis=1)
        np.put_along_axis(
            from_places,
            raised.argmax(axis=1)[:, None, :],
            np.take_along_axis(from_places, raised.argmax(axis=1)[:, None, :], 1) + back[:, None, :FILTERS],
            1,
        )
        from_places *= raised > 0
        to_signs = (from_places @ self.filters.T).reshape(len(codes), places, WIDTH, EMBEDDED)
        embedding = np.zeros_like(self.embedding)
        for i in range(WIDTH):
            np.add.at(embedding, codes[:, i : i + places], to_signs[:, :, i])
        return {
            "embedding": embedding,
            "filters": np.tensordot(spread, from_places, ([0, 1], [0, 1])),
            "offset": from_places.sum(axis=(0, 1)),
            "output": pooled.T @ off,
            "bias": np.array([off.sum()]),
        }

    def epoch(self, codes: np.ndarray, labels: np.ndarray, moments: np.ndarray, number: int, shard: int) -> np.ndarray:
        """Adam steps over shuffled batches; half of the examples lose their surroundings.

        `moments` are those of the epoch before, in the order of `flat`; the new ones are returned.
        """
        draw = np.random.default_rng([13, number, shard])
        first, second = (self.parted(part.copy()) for part in moments)
        batches = np.array_split(draw.permutation(len(codes)), max(1, len(codes) // BATCH))
        for count, part in enumerate(batches, start=number * len(batches) + 1):
            some = codes[part].astype(np.int64)
            bare = draw.random(len(part)) < 0.5
            some[bare] = np.where(some[bare] > 128, some[bare], 0)
            for name, g in self.gradients(some, labels[part]).items():
                m, v = first[name], second[name]
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                getattr(self, name)[...] -= STEP * (m / (1 - 0.9**count)) / (np.sqrt(v / (1 - 0.999**count)) + 1e-8)
        return np.stack([np.concatenate([kept[k].ravel() for k in self.NAMES[:5]]) for kept in (first, second)])

    def flat(self) -> np.ndarray:
        """All learned weights in one row."""
        return np.concatenate([getattr(self, k).ravel() for k in self.NAMES[:5]])

    def parted(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        """One row of numbers by weight, as views of it."""
        sizes = [getattr(self, k).size for k in self.NAMES[:5]]
        parts = np.split(flat, np.cumsum(sizes)[:-1])
        return {k: part.reshape(getattr(self, k).shape) for k, part in zip(self.NAMES[:5], parts)}

    def take(self, flat: np.ndarray) -> None:
        for name, values in self.parted(flat).items():
            setattr(self, name, values.copy())

    def values(self, codes: np.ndarray) -> np.ndarray:
        """Raw scores, before their calibration."""
        return np.concatenate([self.forward(codes[i : i + 512].astype(np.int64))[3] for i in range(0, len(codes), 512)])

    def chances(self, values: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.calibration[0] * values + self.calibration[1], -35, 35)))

    def probability(self, codes: np.ndarray) -> np.ndarray:
        return self.chances(self.values(codes))

    def calibrate(self, value: np.ndarray, labels: np.ndarray, counts: np.ndarray) -> None:
        """Platt scaling by Newton steps, then the recall-constrained threshold."""
        design = np.stack([value, np.ones_like(value)], axis=1)
        for _ in range(25):
            p = 1 / (1 + np.exp(-np.clip(design @ self.calibration, -35, 35)))
            slope = design.T @ (counts * (p - labels)) + 0.01 * self.calibration
            curve = (design * (counts * p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
            self.calibration = self.calibration - np.linalg.solve(curve, slope)
        chance = self.chances(value)
        order = np.argsort(chance[labels == 1], kind="stable")
        up_to = np.cumsum(counts[labels == 1][order])
        most = chance[labels == 1][order][np.searchsorted(up_to, int((1 - RECALL) * up_to[-1]), side="right")]
        below = chance[(labels == 0) & (chance < most)]
        self.threshold = np.array([max(0.5, (most + below.max(initial=0)) / 2)])

    def to_bytes(self) -> bytes:
        file = io.BytesIO()
        np.savez(file, **{k: getattr(self, k) for k in self.NAMES})
        return file.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> "Network":
        network = cls()
        with np.load(io.BytesIO(data)) as kept:
            for k in cls.NAMES:
                setattr(network, k, kept[k])
        return network


def learned_findings(documents: DataFrame) -> DataFrame:
    """codes (of one piece), label, and a hash that deals them, of the candidates of all documents."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes, labels = [], []
            texts = batch.column("text")
            for row in picked(texts):
                text = texts[row].as_py()
                base = base_findings(text)
                for m in CANDIDATE.finditer(text):
                    label = int(any(a < m.end() and m.start() < b for a, _, b in base))
                    for piece in windows(text, m.start(), m.end()):
                        codes.append(piece.tobytes())
                        labels.append(label)
            yield pa.RecordBatch.from_arrays([pa.array(codes, pa.binary()), pa.array(labels, pa.int32())], ["codes", "label"])

    found = documents.select("text").mapInArrow(scan, "codes binary, label int")
    return found.groupBy("codes").agg(F.max("label").alias("label")).withColumn("place", F.xxhash64("codes", F.lit(5)))


def unpacked(rows: pd.DataFrame) -> np.ndarray:
    return np.stack([np.frombuffer(x, np.int16) for x in rows["codes"]])


def next_weights(findings: DataFrame, state: np.ndarray, number: int) -> np.ndarray:
    """Weights and moments after one epoch, each the mean over the shards, in their order."""

    def learn(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows, network = rows.sort_values("codes"), Network()
        network.take(state[0])
        moments = network.epoch(unpacked(rows), rows["label"].to_numpy(float), state[1:], number, int(key[0]))
        learned = np.concatenate([network.flat(), moments.ravel()])
        return pd.DataFrame({"shard": key[0], "at": np.arange(len(learned)), "value": learned})

    learned = findings.groupBy("shard").applyInPandas(learn, "shard long, at int, value double")
    by_shard = F.array_sort(F.collect_list(F.struct("shard", "value")))
    mean = F.aggregate(by_shard, F.lit(0.0), lambda total, x: total + x["value"]) / F.count("value")
    rows = learned.groupBy("at").agg(mean.alias("value")).collect()
    return np.array([value for _, value in sorted(map(tuple, rows))]).reshape(state.shape)


def counted_values(findings: DataFrame, network: Network) -> pd.DataFrame:
    """How many findings of each value (floored) and label there are, with and without surroundings."""
    model = network.to_bytes()

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        network = Network.from_bytes(model)
        for rows in batches:
            if len(rows):
                codes = unpacked(rows)
                for seen in (codes, np.where(codes > 128, codes, 0)):
                    value = np.clip(network.values(seen), -VALUE_MOST, VALUE_MOST)
                    yield pd.DataFrame({"step": np.floor(value * VALUE_STEPS).astype(np.int64), "label": rows["label"]})

    scored = findings.select("codes", "label").mapInPandas(score, "step long, label int")
    return scored.groupBy("step", "label").count().toPandas().sort_values(["step", "label"])


def learn_secrets(documents: DataFrame) -> bytes | None:
    """A network of some kilobytes, trained in shards on the findings of all documents.

    What passes through the driver is bounded: three numbers per weight and epoch, and the
    counts of 2 * VALUE_MOST * VALUE_STEPS values.
    """
    findings = written(learned_findings(documents), "findings")
    aside = F.pmod("place", F.lit(3)) == 0
    counts = {tuple(r)[:2]: r["count"] for r in findings.groupBy(aside.alias("aside"), "label").count().collect()}
    if min(counts.get((part, label), 0) for part in (False, True) for label in (0, 1)) < LEAST_FINDINGS / 3:
        return None
    shards = -(-(counts[False, 0] + counts[False, 1]) // SHARD_FINDINGS)
    learned = findings.where(~aside).withColumn("shard", F.pmod(F.shiftright("place", 8), F.lit(shards)))
    network = Network()
    state = np.stack([network.flat(), *np.zeros((2, len(network.flat())))])
    for number in range(EPOCHS):
        state = next_weights(learned, state, number)
    network.take(state[0])
    values = counted_values(findings.where(aside), network)
    network.calibrate(values["step"].to_numpy(float) / VALUE_STEPS, values["label"].to_numpy(float), values["count"].to_numpy(float))
    return network.to_bytes()


def all_findings(text: str, network: Network | None) -> tuple[list, list]:
    """Base findings and those the network adds."""
    base, added = base_findings(text), []
    if network is None:
        return base, added
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        probability = network.probability(windows(text, start, end)).max()
        if probability >= network.threshold[0] and not any(a < end and start < b for a, _, b in base):
            added.append((start, 3, end))
    return base, added


def scan_secrets(documents: DataFrame, model: bytes | None) -> DataFrame:
    """doc_id, counts, digest of the base findings and all findings of every text."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.from_bytes(model) if model else None
        nothing = hashlib.sha256(b"").hexdigest()
        for batch in batches:
            n = batch.num_rows
            counts, digests, spans = np.zeros((4, n), np.int64), [nothing] * n, [""] * n
            texts = batch.column("text")
            for row in picked(texts):
                base, added = all_findings(texts[row].as_py(), network)
                for _, kind, _ in base + added:
                    counts[kind, row] += 1
                digests[row] = hashlib.sha256(join_findings(base).encode()).hexdigest()
                spans[row] = join_findings(base + added)
            columns = [batch.column("doc_id"), *map(pa.array, counts[:3]), pa.array(digests, pa.string()), pa.array(spans, pa.string()), pa.array(counts[3])]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_model"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        scan, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_model long"
    )


MASK = "[SECRET]"


def masked(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with every maximal run of found characters replaced by one mask."""
    out, last = [], 0
    for start, _, end in sorted(found):
        if start >= last:
            out += [text[last:start], MASK]
        last = max(last, end)
    return "".join([*out, text[last:]])


def mask_secrets(documents: DataFrame, model: bytes | None) -> DataFrame:
    """The documents, all columns, with findings masked and n_chars kept in step."""

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        network = Network.from_bytes(model) if model else None
        for batch in batches:
            texts = batch.column("text")
            new = {}
            for row in picked(texts):
                text = texts[row].as_py()
                base, added = all_findings(text, network)
                if base or added:
                    new[row] = masked(text, base + added)
            yield replace_texts(batch, new)

    return documents.mapInArrow(mask, documents.schema)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return scan_secrets(documents, learn_secrets(documents))
