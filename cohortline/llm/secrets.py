"""Secret scan: fixed patterns, and a guess-cost of values that stand in a credential's place.

The guess-cost is the least number of bits over all ways to cut a value into words, dates, repeats, keyboard walks and
brute-force spans (dynamic programming over end positions). A value that costs many bits is no placeholder.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortline.llm.common import whole_text

# The patterns of the base spans.
ASSIGN = re.compile(r"""(?ai)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

#: Names before a value that make it a credential, for the guess-cost.
CREDENTIAL = re.compile(
    r"""(?ai)(pass(?:word|wd|phrase|code)?|pwd|secret|token|api_?key|auth(?:orization)?|bearer|credentials?|"""
    r"""(?:private|access|secret|client|encryption|signing)_?(?:key|secret|token))["']?\x20*(?:[:=]|\x20is\x20)\x20*["']?"""
    r"""([^\x00-\x20"'<>`]{6,})""")
HINTS = ("pass", "pwd", "secret", "token", "api", "auth", "bearer", "credential", "key")

#: Common parts of passwords, the most common first. A caller can give a longer list.
WORDS = (
    "password pass admin user login welcome letmein master dragon monkey shadow secret love hello test guest root "
    "super money summer winter spring autumn sunday monday friday january march april june july august october "
    "football baseball soccer hockey hunter ranger killer tiger eagle angel princess flower sunshine computer internet "
    "server system default changeme example sample demo your key token value string here none null true false "
    "abc qwerty access account service config public private data base mail home office company work team star "
    "blue red green black white silver gold orange"
).split()
KEY_ROWS = ("qwertyuiop", "asdfghjkl", "zxcvbnm", "1234567890", "abcdefghijklmnopqrstuvwxyz")
# Forms of dates, each at any place of a value.
DATES = [re.compile(rf"(?a)(?=({form}))") for form in (
    r"(?:19|20)\d\d([-/._]?)(?:0[1-9]|1[0-2])\2(?:0[1-9]|[12]\d|3[01])",
    r"(?:0[1-9]|[12]\d|3[01])([-/._]?)(?:0[1-9]|1[0-2])\2(?:19|20)\d\d", r"(?:19|20)\d\d")]
LEET = str.maketrans("@430157$!", "aaeoistsi")


def _alphabet(c: str) -> float:
    if c.isdigit():
        return math.log2(10)
    if c.isascii() and c.isalpha():
        return math.log2(26)
    return math.log2(33 if c.isascii() else 1000)


class GuessCost:
    """bits(value): the cheapest segmentation. Longer word lists cost little: only substrings are looked up."""

    def __init__(self, words: Iterable[str] = WORDS) -> None:
        self.rank = {w: i + 1 for i, w in reversed(list(enumerate(words)))}
        self.longest = max(map(len, self.rank), default=0)

    def bits(self, value: str) -> float:
        """Dates at every place, every part of a walk and every number of repeats compete; time grows about with the length."""
        n, dates = len(value), {}
        for form in DATES:
            for m in form.finditer(value):
                dates.setdefault(m.end(1), []).append((m.start(1), math.log2(365 * 130) if m.end(1) - m.start(1) > 4 else math.log2(130)))
        low = value.lower()
        low = low if len(low) == n else value  # a letter whose small form is longer
        plain = low.translate(LEET)
        best = [0.0] * (n + 1)
        same = dict.fromkeys((1, 2, 3, 4), 0)  # for each size of block: so many letters up to here equal the one a block before
        starts = {size: [[] for _ in range(size)] for size in same}  # where repeats may begin, by the place in the block
        lines = [line for row in KEY_ROWS for line in (row, row[::-1])]
        runs = [0] * len(lines)  # for each line: so many letters up to here follow each other on it
        mixed = math.log2(3)  # which kind of span comes next
        for j in range(1, n + 1):
            letter = low[j - 1]
            cost = best[j - 1] + _alphabet(value[j - 1]) + (1.0 if value[j - 1].isupper() else 0.0)
            for i in range(max(0, j - self.longest), j - 2):
                rank = self.rank.get(plain[i:j])
                if rank:
                    own = value[i:j]
                    cost = min(cost, best[i] + mixed + math.log2(rank + 1) + (own != own.lower()) + (own.lower() != plain[i:j]))
            for i, own in dates.get(j, ()):
                cost = min(cost, best[i] + mixed + own)
            for k, line in enumerate(lines):
                place = line.find(letter)
                runs[k] = 0 if place < 0 else runs[k] + 1 if j > 1 and place and runs[k] and line[place - 1] == low[j - 2] else 1
                for length in range(3, runs[k] + 1):
                    cost = min(cost, best[j - length] + mixed + math.log2(2 * len(KEY_ROWS) * len(line) * length))
            for size in same:
                same[size] = same[size] + 1 if j > size and value[j - 1] == value[j - 1 - size] else 0
                if not same[size]:
                    for kept in starts[size]:
                        kept.clear()
                elif same[size] >= 2 * size:  # a block repeated up to here, at least three times
                    kept, i = starts[size][j % size], j - 3 * size
                    # A longer repeat that is no dearer now stays so, since log2 grows ever slower: a new start has to be cheaper.
                    if all(best[k] + math.log2((j - k) // size) > best[i] + math.log2(3) for k in kept):
                        kept[:] = [k for k in kept if best[k] < best[i]]
                        kept.append(i)
                    block = sum(map(_alphabet, value[j - size : j]))
                    cost = min(cost, min(best[k] + math.log2((j - k) // size) for k in kept) + mixed + block)
            best[j] = cost
        return best[n]


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the fixed patterns, leftmost and without overlap within a kind."""
    found = []
    low = text.lower()
    if any(x in low for x in ("passw", "secret", "token", "api")):
        found += [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), "access", m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    return found + [(m.start(), "hex", m.end()) for m in HEX.finditer(text)]


def guess_spans(text: str, cost: GuessCost, bits: float) -> list[tuple[int, str, int]]:
    """Values in a credential's place that cost `bits` or more."""
    low = text.lower()
    if not any(x in low for x in HINTS):
        return []
    return [(m.start(2), "guess", m.end(2)) for m in CREDENTIAL.finditer(text) if cost.bits(m[2]) >= bits]


def _joined(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in sorted(spans, key=lambda s: (s[0], KINDS.index(s[1]), s[2])))


def find_secrets(docs: DataFrame, bits: float = 45.0, words: Iterable[str] = WORDS, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_guess: one row for each input row.

    Spans are `kind:start:end` in code points, the end exclusive, in order of start and then of kind. `guess` spans are the values themselves; base
    spans stay whether or not their value is costly. A null or empty text has no span, and its base_sha256 is that of the empty
    string; repeated rows and null ids come back as they are. Whole texts are scanned, of any length."""
    known = tuple(words)

    def scan(batches):
        cost = GuessCost(known)
        for b in batches:
            rows = []
            for t in b["t"]:
                text = t.as_py()
                base = base_spans(text)
                more = guess_spans(text, cost, bits)
                count = lambda kind: sum(s[1] == kind for s in base)
                rows.append((*map(count, KINDS[:3]), hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(base + more),
                             len(more)))
            columns = list(zip(*rows)) or [()] * 6
            kinds = [pa.int64()] * 3 + [pa.string()] * 2 + [pa.int64()]
            yield pa.RecordBatch.from_arrays([b["id"], *(pa.array(c, k) for c, k in zip(columns, kinds))], names)

    schema = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_guess long"
    names = [x.split()[0] for x in schema.split(", ")]
    return docs.select(F.col(id_col).cast("long").alias("id"), whole_text(text_col).alias("t")).mapInArrow(scan, schema)
