"""Find secrets in texts: known patterns, and strings whose characters are too evenly mixed to be words."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from martkit.llm.common import columns_of, steps

# The base patterns and their least lengths, in the order of kinds.
KINDS = ("assign", "access", "hex")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ASSIGN_LEAST = 12
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
ACCESS_LEAST = 18
HEX = re.compile(r"[0-9a-f]{16,}")  # runs of 16 characters or more; shorter ones never count


@dataclass(frozen=True)
class EntropyRules:
    """Which strings the entropy scan looks at, and from which entropy in bits a window counts."""

    candidate: str = r"[A-Za-z0-9+/_=-]{20,}"
    window: int = 20
    # Character classes: a stretch of a candidate made of these characters, and its threshold.
    classes: tuple[tuple[str, float], ...] = ((r"[0-9a-fA-F]{20,}", 3.0), (r"[A-Za-z0-9+/_=-]{20,}", 3.9))
    # Strings that are no secrets although they look mixed: words, numbers, ids in groups, paths, placeholders.
    allowed: tuple[str, ...] = (
        r"[A-Za-z]+",
        r"[0-9]+",
        r"[A-Za-z]+([-_/][A-Za-z]+)+",
        r"[0-9a-fA-F]{8}(-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}",
        r"(?i).*(example|placeholder|dummy|xxxx).*",
    )


class EntropyScan:
    def __init__(self, rules: EntropyRules):
        self.candidate = re.compile(rules.candidate)
        self.window = rules.window
        self.classes = [(re.compile(p), t) for p, t in rules.classes]
        self.allowed = [re.compile(p) for p in rules.allowed]
        n = rules.window
        # Entropy is log2(n) less the mean of c * log2(c) / n over counts c; a step changes two counts.
        self.up = [((c + 1) * math.log2(c + 1) - (c * math.log2(c) if c else 0)) / n for c in range(n)]

    def windows(self, text: str, threshold: float) -> list[tuple[int, int]]:
        """Stretches of ``text`` covered by windows whose entropy reaches the threshold."""
        n, up, counts, entropy, out = self.window, self.up, {}, math.log2(self.window), []
        for i, c in enumerate(text):
            if i >= n:
                gone = text[i - n]
                counts[gone] -= 1
                entropy += up[counts[gone]]
            have = counts.get(c, 0)
            entropy -= up[have]
            counts[c] = have + 1
            if i >= n - 1 and entropy >= threshold - 1e-9:
                start = i - n + 1
                if out and start <= out[-1][1]:
                    out[-1] = (out[-1][0], i + 1)
                else:
                    out.append((start, i + 1))
        return out

    def spans(self, text: str) -> list[tuple[int, int]]:
        found: set[tuple[int, int]] = set()
        for m in self.candidate.finditer(text):
            string = m[0]
            if any(p.fullmatch(string) for p in self.allowed):
                continue
            for pattern, threshold in self.classes:
                for part in pattern.finditer(string):
                    if not any(p.fullmatch(part[0]) for p in self.allowed):
                        at = m.start() + part.start()
                        found |= {(at + a, at + b) for a, b in self.windows(part[0], threshold)}
        return sorted(found)


def spans_of(text: str, scan: EntropyScan) -> list[tuple[int, int, str]]:
    """All spans of one text by start, then kind as listed: code points, end exclusive.

    Entropy spans inside a base span or inside another entropy span say nothing new and are left out.
    """
    base = []
    if ":" in text or "=" in text:
        base += [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        base += [(m.start(), m.end(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    base += [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    base.sort()
    more, reach, covered, i = [], 0, 0, 0
    for a, b in sorted(scan.spans(text), key=lambda s: (s[0], -s[1])):
        # The farthest end of the base spans that begin no later: both lists are walked once.
        while i < len(base) and base[i][0] <= a:
            covered = max(covered, base[i][1])
            i += 1
        if b > reach and b > covered:
            more.append((a, b, "entropy"))
            reach = b
    order = {k: i for i, k in enumerate((*KINDS, "entropy"))}
    return sorted([*base, *more], key=lambda s: (s[0], order[s[2]], s[1]))


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: EntropyRules | None = None) -> DataFrame:
    """``(doc_id, spans)`` of each row: ``array<struct<kind,start,end>>`` in order.

    A null or empty text has no spans; repeated rows give repeated rows.  Whole texts are read; nothing is shuffled.
    """
    rules = rules or EntropyRules()
    frame = columns_of(docs, key, text)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = EntropyScan(rules)
        for part in steps(batches):
            spans = [[{"kind": k, "start": a, "end": b} for a, b, k in spans_of(t or "", scan)] for t in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=["doc_id", "spans"])

    of_key = frame.schema["doc_id"].dataType.simpleString()
    return frame.mapInArrow(run, f"doc_id {of_key}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def secret_report(docs: DataFrame, key: str = "doc_id", text: str = "text", rules: EntropyRules | None = None) -> DataFrame:
    """Per row: counts by base kind, digest of the base spans, all spans as one text."""
    found = find_secrets(docs, key, text, rules)
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS))
    return found.select(
        "doc_id",
        *[of(k) for k in KINDS],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"),
        _listed(F.col("spans")).alias("spans"),
    )


def mask_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text", mask: str = "*") -> DataFrame:
    """``(doc_id, text)`` with every character of a found span replaced; a null text stays null."""
    scan_rules = EntropyRules()
    frame = columns_of(docs, key, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scan = EntropyScan(scan_rules)
        for part in steps(batches):
            out = []
            for t in part.column(1).to_pylist():
                for a, b, _ in spans_of(t, scan) if t else ():
                    t = t[:a] + mask * (b - a) + t[b:]
                out.append(t)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(out, pa.string())], names=["doc_id", "text"])

    return frame.mapInArrow(run, frame.schema)
