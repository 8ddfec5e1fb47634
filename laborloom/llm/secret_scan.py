"""Secrets found by rules, and by a small convolutional network over every other candidate.

Three rules give the base findings: assignments to names such as ``password``, access-key
ids and long hexadecimal runs. Every other run of at least 16 characters of a key's alphabet,
and every such part of a run that base findings leave uncovered, is a candidate; a character network in numpy looks at it and 16 characters on either side. It
reads long candidates in overlapping windows of 48 characters, whose best score counts.
The network learns from labelled findings: candidates of a bounded sample of the documents,
positive where a rule confirms them, and findings made by fixed recipes of well-known key
shapes, also behind long paths and names, and of harmless runs. Its score is calibrated on
findings held out from it, and the threshold is the highest that keeps RECALL of those.

A span is (kind, start, end) in code points, end exclusive. Null and empty texts have none.
"""

from __future__ import annotations

import bisect
import hashlib
import itertools
import re
import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laborloom.llm.shared import saved, ship

Span = tuple[str, int, int]
#: The base rules.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex")
SHORTEST = 16
CANDIDATE = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
SAMPLE_DOCS, SAMPLE_FINDINGS, MADE_FINDINGS, LATE_FINDINGS = 2000, 3000, 3000, 2000
RECALL = 0.98
CONTEXT, INNER = 16, 48
LENGTH = 2 * CONTEXT + INNER
#: Windows of a long candidate begin this far apart; fewer characters of a key than LEAST in one say nothing.
STEP, LEAST = 24, 16
AT_ONCE = 4096
ALPHABET = string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_.=-\"':; \n()<>@"
CODES = {c: i + 2 for i, c in enumerate(ALPHABET)}  # 0 outside the text, 1 any other character
FILTERS, WIDTH, EPOCHS = 16, 5, 12
_NAMED = re.compile(r"password|passwd|secret|token|api_?key", re.IGNORECASE | re.ASCII)
REDACTED = "[SECRET]"


def base_spans(text: str) -> list[Span]:
    """Findings of the rules by start, then kind."""
    found: list[Span] = []
    if _NAMED.search(text):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str, taken: list[Span]) -> list[tuple[int, int, bool]]:
    """Runs that may be keys: start, end and whether one of the findings ``taken``, which are
    in order of their starts, overlaps."""
    out, at, reach = [], 0, 0
    for m in CANDIDATE.finditer(text):
        start, end = m.span()
        while at < len(taken) and taken[at][1] < end:
            reach = max(reach, taken[at][2])
            at += 1
        out.append((start, end, start < reach))
    return out


def windows(text: str, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """Places and codes of the windows of a candidate, each with the characters before and after it."""
    before = text[max(0, start - CONTEXT):start].rjust(CONTEXT, "\0")
    inside = text[start:end].ljust(INNER, "\0")
    after = text[end:end + CONTEXT].ljust(CONTEXT, "\0")
    codes = bytes(0 if c == "\0" else CODES.get(c, 1) for c in before + inside + after)
    last = len(inside) - INNER
    for i in (*range(0, last, STEP), last):
        yield start + i, codes[i:i + LENGTH]


def merged(spans: list[Span]) -> list[tuple[int, int]]:
    """The stretches that findings, which are in order of their starts, cover."""
    out: list[tuple[int, int]] = []
    for _, start, end in spans:
        if out and start <= out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def touching(covered: list[tuple[int, int]], start: int, end: int) -> list[tuple[int, int]]:
    """Those of the ``covered`` stretches that share characters with one."""
    return covered[bisect.bisect_right(covered, start, key=lambda s: s[1]):bisect.bisect_left(covered, (end,))]


def uncovered(found: list[tuple[int, int, bool]], covered: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """Candidates that no finding covers, and such parts of the others that are as long as a candidate."""
    for start, end, known in found:
        if not known:
            yield start, end
            continue
        at = start
        for a, b in (*touching(covered, start, end), (end, end)):
            if a - at >= SHORTEST:
                yield at, a
            at = b


def labelled_windows(text: str, start: int, end: int, covered: list[tuple[int, int]]) -> Iterator[tuple[bytes, int]]:
    """Windows of a candidate: 1 with a key in it, 0 with none; long ones with a bit of one are left out."""
    for at, codes in windows(text, start, end):
        keys = touching(covered, at, min(end, at + INNER))
        shared = [(min(b, at + INNER) - max(a, at), b - a) for a, b in keys]
        if end - start <= INNER or not keys or any(both >= min(LEAST, whole) for both, whole in shared):
            yield codes, int(bool(keys))


def _recipes(rng: np.random.Generator) -> tuple[Callable, Callable, list[Callable], list[Callable]]:
    """Makers of characters, of words, of keys and of harmless runs."""
    pick = lambda chars, n: "".join(rng.choice(list(chars), n))
    syllables = "an er th in on re ti es st en at nd or ha be la de le un ei ch ie os ra ci qu ar lo".split()
    word = lambda n: "".join(rng.choice(syllables, n))
    alnum, hexa = string.ascii_letters + string.digits, "0123456789abcdef"
    keys = [
        lambda: pick(alnum, rng.integers(20, 45)), lambda: pick(alnum + "+/", rng.integers(24, 60)) + "==",
        lambda: "ghp_" + pick(alnum, 36), lambda: "sk_live_" + pick(alnum, 24), lambda: "xoxb-" + pick(string.digits, 12)
        + "-" + pick(alnum, 24), lambda: "AKIA" + pick(string.ascii_uppercase + string.digits, 16),
        lambda: pick(hexa, rng.integers(24, 65)), lambda: pick(hexa.upper(), 32), lambda: "eyJ" + pick(alnum + "-_", 40),
    ]
    harmless = [
        lambda: word(rng.integers(8, 16)), lambda: word(rng.integers(8, 14)).capitalize(),
        lambda: word(rng.integers(8, 14)).upper(), lambda: pick(string.digits, rng.integers(16, 20)),
        lambda: "-".join(word(2) for _ in range(5)), lambda: "_".join(word(2) for _ in range(4)),
        lambda: "/".join(word(2) for _ in range(5)), lambda: pick("=-_", 1) * int(rng.integers(16, 50)),
        lambda: "2024-%02d-%02d-%02d-%02d-00" % tuple(rng.integers(1, 13, 4)), lambda: word(4) + "/" + word(4),
    ]
    return pick, word, keys, harmless


def made_findings(count: int) -> list[tuple[bytes, int]]:
    """Labelled findings of fixed recipes, the same in every run."""
    rng = np.random.default_rng(11)
    _, word, keys, harmless = _recipes(rng)
    named = ["api_key = \"", "token: ", "Authorization: Bearer ", "secret=", "key ", "export KEY=", "login with ", ""]
    plain = ["see ", "the ", "at ", "", ". ", "\n", "id ", "name: "]
    out = []
    for i in range(count):
        positive = i % 2
        recipes, leads = (keys, named) if positive else (harmless, plain)
        value = recipes[rng.integers(len(recipes))]()
        lead = word(4) + " " + leads[rng.integers(len(leads))]
        text = lead + value + ("\" " if lead.endswith('"') else " ") + word(5)
        out.append((next(windows(text, len(lead), len(lead) + len(value)))[1], positive))
    return out


def late_findings(count: int) -> list[tuple[bytes, int]]:
    """Labelled windows of long runs, every second run with a key somewhere in it, the same in every run."""
    rng = np.random.default_rng(12)
    pick, word, keys, _ = _recipes(rng)
    joined = lambda sign: sign.join(word(rng.integers(1, 4)) for _ in range(rng.integers(8, 30)))
    long = [
        lambda: "/" + joined("/"), lambda: joined("_"), lambda: joined("-"), lambda: joined("/").title(),
        lambda: joined("_").upper(), lambda: "/services/" + joined("/"), lambda: word(rng.integers(24, 60)),
        lambda: pick("=-_/", 1) * int(rng.integers(49, 200)), lambda: "/".join([joined("-"), joined("_")]),
        lambda: "/".join(pick(string.digits, 4) for _ in range(rng.integers(10, 30))),
    ]
    out: list[tuple[bytes, int]] = []
    for i in itertools.count():
        if len(out) >= count:
            return out[:count]
        head, key, tail = long[rng.integers(len(long))](), "", ""
        if i % 2:
            sign = pick("/_-=", 1)
            key, tail = keys[rng.integers(len(keys))](), "" if i % 4 == 1 else sign + long[rng.integers(len(long))]()
            head += sign
        lead = word(4) + " "
        start, end = len(lead) + len(head), len(lead) + len(head) + len(key)
        text = lead + head + key + tail + " " + word(5)
        out += labelled_windows(text, len(lead), end + len(tail), [(start, end)] if key else [])


@dataclass
class Network:
    """Characters → one convolution → rectified maximum and mean over places → logistic output."""

    kernel: np.ndarray  # WIDTH × codes × FILTERS
    bias: np.ndarray
    weights: np.ndarray
    offset: float = 0.0
    slope: float = 1.0  # calibration: slope and shift of the logit
    shift: float = 0.0
    threshold: float = 1.0

    def _maps(self, codes: np.ndarray) -> np.ndarray:
        places = codes.shape[1] - WIDTH + 1
        out = np.zeros((len(codes), places, FILTERS), dtype=np.float32) + self.bias
        for j in range(WIDTH):
            out += self.kernel[j][codes[:, j:j + places]]
        return out

    def logits(self, codes: np.ndarray) -> np.ndarray:
        out = []
        for i in range(0, len(codes), 512):
            maps = np.maximum(self._maps(codes[i:i + 512]), 0)
            out.append(np.concatenate([maps.max(axis=1), maps.mean(axis=1)], axis=1) @ self.weights + self.offset)
        return np.concatenate([np.zeros(0), *out])

    def scores(self, codes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.slope * self.logits(codes) + self.shift)))


def _codes(windows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(windows), dtype=np.uint8).reshape(len(windows), LENGTH)


def trained(windows: list[bytes], labels: list[int]) -> Network:
    """A network fitted to four of five findings, calibrated and thresholded on the fifth."""
    x, y = _codes(windows), np.array(labels, dtype=np.float32)
    held = np.arange(len(y)) % 5 == 4
    rng = np.random.default_rng(5)
    net = Network((rng.normal(0, 0.3, (WIDTH, len(ALPHABET) + 2, FILTERS))).astype(np.float32),
                  np.zeros(FILTERS, dtype=np.float32), rng.normal(0, 0.3, 2 * FILTERS).astype(np.float32))
    train, one_hot = np.flatnonzero(~held), np.eye(len(ALPHABET) + 2, dtype=np.float32)
    state = [np.zeros_like(net.kernel), np.zeros_like(net.bias), np.zeros_like(net.weights), 0.0]
    for epoch in range(EPOCHS):
        order = rng.permutation(train)
        for i in range(0, len(order), 64):
            part = order[i:i + 64]
            codes = x[part]
            maps = net._maps(codes)
            live = np.maximum(maps, 0)
            top = live.argmax(axis=1)
            pooled = np.concatenate([live.max(axis=1), live.mean(axis=1)], axis=1)
            error = (1 / (1 + np.exp(-(pooled @ net.weights + net.offset))) - y[part]) / len(part)
            back = error[:, None] * net.weights[None, :]
            grad = np.repeat(back[:, None, FILTERS:] / live.shape[1], live.shape[1], axis=1)
            rows, cols = np.arange(len(part))[:, None], np.arange(FILTERS)[None, :]
            grad[rows, top, cols] += back[:, :FILTERS]
            grad *= maps > 0
            flat = grad.reshape(-1, FILTERS)
            kernel = np.stack([one_hot[codes[:, j:j + grad.shape[1]].ravel()].T @ flat for j in range(WIDTH)])
            steps = [kernel, grad.sum(axis=(0, 1)), pooled.T @ error, float(error.sum())]
            rate = 0.05 * (1 - epoch / EPOCHS) + 0.005
            for k, step in enumerate(steps):  # scaled by the root of past squares
                state[k] = state[k] * 0.95 + 0.05 * step**2
                steps[k] = rate * step / (np.sqrt(state[k]) + 1e-4)
            net.kernel -= steps[0]
            net.bias -= steps[1]
            net.weights -= steps[2]
            net.offset -= steps[3]
    raw, truth = net.logits(x[held]), y[held]
    for _ in range(200):  # calibration by logistic regression on the logit
        p = 1 / (1 + np.exp(-(net.slope * raw + net.shift)))
        net.slope -= 0.5 * float(((p - truth) * raw).mean()) / (1 + float((raw**2).mean()))
        net.shift -= 0.5 * float((p - truth).mean())
    kept = np.sort(net.scores(x[held])[truth == 1])
    net.threshold = float(kept[int((1 - RECALL) * len(kept))])
    return net


def labelled_findings(docs: DataFrame) -> list[tuple[bytes, int]]:
    """Candidates of at most SAMPLE_DOCS documents, at most SAMPLE_FINDINGS, chosen by hashes."""
    ids = saved(docs.select("doc_id").distinct().orderBy(F.xxhash64(F.lit("secrets"), "doc_id")).limit(SAMPLE_DOCS))
    chosen = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left_semi")  # SAMPLE_DOCS rows

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for text in batch.column("text").to_pylist():
                known = base_spans(text or "")
                covered = merged(known)
                found = (labelled for start, end, _ in candidates(text or "", known)
                         for labelled in labelled_windows(text, start, end, covered))
                while part := list(itertools.islice(found, AT_ONCE)):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([codes for codes, _ in part], pa.binary()),
                         pa.array([label for _, label in part], pa.int32())], ["window", "label"])

    rows = chosen.mapInArrow(each, "window binary, label int").distinct()
    rows = rows.orderBy(F.xxhash64("window"), "window").limit(SAMPLE_FINDINGS)
    return [(bytes(r.window), r.label) for r in rows.collect()]


def network(docs: DataFrame) -> Network:
    """The network for these documents; the driver gets a bounded sample of short windows."""
    ship(docs.sparkSession)
    findings = made_findings(MADE_FINDINGS) + late_findings(LATE_FINDINGS) + labelled_findings(docs)
    order = np.random.default_rng(3).permutation(len(findings))
    return trained([findings[i][0] for i in order], [findings[i][1] for i in order])


def all_spans(texts: list[str], net: Network) -> list[tuple[list[Span], list[Span]]]:
    """Base findings and all findings of each text by start, then kind."""
    base = [base_spans(t) for t in texts]
    added: dict[int, list[Span]] = {}
    waiting: list[tuple[int, int, int, bytes]] = []

    def judge() -> None:
        scores = net.scores(_codes([codes for *_, codes in waiting]))
        for (i, start, end, _), score in zip(waiting, scores.tolist(), strict=True):
            own = added.setdefault(i, [])
            # The windows of a candidate follow each other.
            if score >= net.threshold and own[-1:] != [("network", start, end)]:
                own.append(("network", start, end))
        waiting.clear()

    for i, text in enumerate(texts):
        for start, end in uncovered(candidates(text, base[i]), merged(base[i])):
            for _, codes in windows(text, start, end):
                waiting.append((i, start, end, codes))
                if len(waiting) == AT_ONCE:
                    judge()
    if waiting:
        judge()
    order = {kind: k for k, kind in enumerate((*KINDS, "network"))}
    return [(own, sorted([*own, *added.get(i, [])], key=lambda s: (s[1], order[s[0]]))) for i, own in enumerate(base)]


def redacted(text: str, spans: list[Span]) -> str:
    """The text with every stretch that findings cover replaced."""
    parts, at = [], 0
    for _, start, end in spans:
        if start >= at:
            parts += [text[at:start], REDACTED]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def _line(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for kind, a, b in spans)


def scanned(docs: DataFrame, net: Network) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans, redacted."""
    ship(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = [t or "" for t in part.column("text").to_pylist()]
                found = all_spans(texts, net)
                counts = [[sum(s[0] == kind for s in own) for own, _ in found] for kind in KINDS]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id").cast(pa.int64()), *(pa.array(c, pa.int64()) for c in counts),
                    pa.array([hashlib.sha256(_line(own).encode()).hexdigest() for own, _ in found], pa.string()),
                    pa.array([_line(spans) for _, spans in found], pa.string()),
                ], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return docs.select("doc_id", "text").mapInArrow(
        each, "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")


def without_secrets(docs: DataFrame, net: Network) -> DataFrame:
    """The documents with secrets replaced by REDACTED, and n_chars, where there is one, to match.

    Texts without findings, null too, stay as they are.
    """
    ship(docs.sparkSession)

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 512):
                part = batch.slice(i, 512)
                texts = part.column("text").to_pylist()
                found = all_spans([t or "" for t in texts], net)
                new = [redacted(t, spans) if spans else t for t, (_, spans) in zip(texts, found, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), pa.array(new, pa.string()), pa.array([bool(s) for _, s in found])],
                    ["row", "text", "changed"])

    rows = docs.select(F.struct("*").alias("row"), "text")
    kind = docs.select(F.struct("*").alias("row")).schema["row"].dataType.simpleString()
    out = rows.mapInArrow(each, f"row {kind}, text string, changed boolean")
    new = {"text": F.when(F.col("changed"), F.col("text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        kept = F.col("row.n_chars")
        new["n_chars"] = F.when(F.col("changed"), F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(kept)
    return out.select(*[new.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
