r"""License scan by ordered signature rules.

A text is lower-cased (A-Z) and split into words. Every rule names words without which it cannot
match; only rules whose words occur are tried, each with its regex over the whole text. What they
find are intervals. Detections are taken in order of priority, then length, then place; one that
lies inside an interval already taken is suppressed. A tag or grant goes on: the further licenses
of an SPDX expression, or those joined to a granted one by "or" and "and", have its priority and
score. Base phrases, counted by words at all their
places, are rules of the least priority: a place inside another detection is suppressed as a
detection, but its label stays, since the place is still a mention.

Defined results: a null text is empty; without detection the labels are the empty string, the
score 0 and the words null; rows that repeat are scanned each; an empty table gives no row.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import shared
from .license_rules import BASE, GRANT_SCORE, NEGATION, NEGATION_REACH, Rule, joined, rules, tagged

#: A-Z to lower case, every other byte that no word has to a space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The same with every byte beyond ASCII to a space too, as a quotation mark may touch a word.
GATE_BYTES = bytes(b if b < 128 else 32 for b in WORD_BYTES)
BASE_PRIORITY, BASE_SCORE = 90, 0.5
#: Characters of a word in lower-cased text, and those between words.
WORD, NO_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]", r"[\x00-\x2F\x3A-\x60\x7B-\x7F]"
SCANNED = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, n_detections long, detections array<struct<label:string,start:long,stop:long,priority:int>>"


class Detection(NamedTuple):
    label: str
    start: int
    stop: int
    priority: int
    score: float


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


def gate_words(text: bytes, present: set[bytes]) -> set[bytes]:
    """Words by which rules are chosen; those that end in a version also without it."""
    plain = present if text.isascii() else set(text.translate(GATE_BYTES).split())
    bare = {w.rstrip(b"0123456789") for w in plain if w[-1] < 58}
    return plain | bare | {w[:-1] for w in bare if w.endswith(b"v")}


def resolve(found: list[Detection]) -> list[Detection]:
    """Those not contained in one that comes before by priority, length and place."""
    taken: list[Detection] = []
    starts: list[int] = []
    reach: list[int] = []  # the furthest stop among the taken ones that start up to here
    for d in sorted(found, key=lambda d: (d.priority, d.start - d.stop, d.start, d.label)):
        at = bisect_right(starts, d.start)
        if at and reach[at - 1] >= d.stop:
            continue
        starts.insert(at, d.start)
        reach.insert(at, max(d.stop, reach[at - 1] if at else 0))
        for i in range(at + 1, len(reach)):
            if reach[i] >= d.stop:
                break
            reach[i] = d.stop
        taken.append(d)
    return sorted(taken, key=lambda d: (d.start, d.stop, d.label))


class Scanner:
    """Rules made ready: compiled, and listed by the rarest of the words they need."""

    def __init__(self, table: list[Rule] | None = None):
        self.by_word: dict[bytes, list] = {}
        for rule in rules() if table is None else table:
            groups = [{w.encode() for w in g} for g in rule.words]
            entry = (rule, groups, re.compile(rule.regex, re.DOTALL))
            for word in groups[-1]:
                self.by_word.setdefault(word, []).append(entry)
        self.keywords = frozenset(self.by_word)
        self.phrases = [([w.encode() for w in phrase.split()], label) for phrase, label in BASE]
        self.places = [(label, re.compile(rf"(?<!{WORD}){f'{NO_WORD}+'.join(phrase.split())}(?!{WORD})")) for phrase, label in BASE]
        self.ends = {words[-1] for words, _ in self.phrases}

    def base(self, words: list[bytes], present: set[bytes]) -> list[tuple[int, str]]:
        """Word places and labels of the base phrases."""
        found = []
        for phrase, label in self.phrases:
            if not present.issuperset(phrase):
                continue
            at = -1
            try:
                while True:
                    at = words.index(phrase[0], at + 1)
                    if words[at : at + len(phrase)] == phrase:
                        found.append((at, label))
            except ValueError:
                pass
        return sorted(found)

    def detect(self, text: bytes, present: set[bytes], base: bool = False) -> list[Detection]:
        """What the rules find, and the base phrases too if there are any."""
        tried, found = set(), []
        present = gate_words(text, present)
        lowered = None
        for word in self.keywords & present:
            for entry in self.by_word[word]:
                rule, groups, regex = entry
                if id(entry) in tried or not all(g & present for g in groups):
                    continue
                tried.add(id(entry))
                if lowered is None:
                    lowered = text.lower().decode()
                found += [Detection(rule.label, m.start(), m.end(), rule.priority, rule.score) for m in regex.finditer(lowered)]
        found = [d for d in found if d.score != GRANT_SCORE or not NEGATION.search(lowered[max(0, d.start - NEGATION_REACH) : d.start])]
        if b"spdx" in present and lowered is not None:
            found += [Detection(label, a, b, 10, 1.0) for label, a, b in tagged(lowered)]
        for stop, priority, score in {(d.stop, d.priority, d.score) for d in found if d.priority == 30}:
            found += [Detection(label, a, b, priority, score) for label, a, b in joined(lowered, stop)]
        if base:
            lowered = text.lower().decode() if lowered is None else lowered
            found += [Detection(label, m.start(), m.end(), BASE_PRIORITY, BASE_SCORE) for label, regex in self.places for m in regex.finditer(lowered)]
        return resolve(found)

    def __call__(self, text: bytes) -> tuple:
        words = words_of(text)
        present = set(words)
        base = self.base(words, present)
        found = self.detect(text, present, bool(base))
        labels = {d.label for d in found} | {label for _, label in base}
        score = max([0.0, *(d.score for d in found), *(BASE_SCORE for _ in base[:1])])
        join = lambda x: ",".join(sorted(set(x)))
        return len(words), len(base), base[0][0] if base else None, base[-1][0] if base else None, join(x for _, x in base), join(labels), score, len(found), [{"label": d.label, "start": d.start, "stop": d.stop, "priority": d.priority} for d in found]


def _scan(table: list[Rule] | None):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        scanner = Scanner(table)
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.int64(), pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("priority", pa.int32())]))]
        names = [f.split()[0] for f in SCANNED.split(", ")]
        for batch in batches:
            rows = list(zip(*[scanner(t) for t in shared.text_bytes(batch.column(1))], strict=True)) or [[]] * len(kinds)
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(list(c), k) for c, k in zip(rows, kinds, strict=True))], names=names)

    return run


def scan_licenses(docs: DataFrame, table: list[Rule] | None = None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document words, base places, labels, score and the detections with their intervals (in
    code points of the lower-cased text); see SCANNED. ``table`` replaces the rules."""
    shared.prepare(docs.sparkSession)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(_scan(table), SCANNED)
