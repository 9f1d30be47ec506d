"""Secret scans: parts of credentials, linked by an interval join within scopes.

A credential has parts: an access identifier, a secret and an endpoint. Some patterns are secrets by
themselves (the base kinds: ``assign``, ``access``, ``hex``) and are always reported. All others are weak candidates, which
most texts hold harmlessly: a user name, a long mixed token, a host. They are reported only if complementary parts
co-occur, that is if they lie in the same scope and no more than ``reach`` code points apart:

- a weak secret needs an identifier, or, if a key word names it, an endpoint;
- an identifier or an endpoint needs a reported secret that a key word names, or that has an identifier.

A scope ends at a blank line and at a section header in square brackets. Each scope's parts are joined as
intervals: the parts of a role are sorted, with the running largest end, so that the nearest part on either side is
found by one binary search, and a scope of n parts costs n log n however close together they lie.

A document is read in its own row, without a shuffle. Offsets count code points; ends are exclusive.

Cases: a null or empty text has no spans. Repeated rows give one result each; null ids are passed
through; an empty table gives an empty result. Other columns are not read. Spans of different kinds may overlap.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Kinds in their order; the first three are the base.
BASE = ("assign", "access", "hex")
KINDS = (*BASE, "secret", "ident", "endpoint")
REACH = 200

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")  # the maximal runs that are long enough

#: Key words (lower case, without _ and -) before : or =, by the role of their value.
KEYS = {"ident": "user username login account accountid clientid appid keyid accesskey accesskeyid tenant tenantid",
        "secret": "pwd pass passphrase credential credentials auth authorization bearer privatekey clientkey accountkey "
                  "sharedkey sessionkey signingkey",
        "endpoint": "host hostname server endpoint url baseurl address addr domain database"}
_ROLE = {w: role for role, words in KEYS.items() for w in words.split()}
_VALUE = {"ident": re.compile(r"""\x20*["']?([A-Za-z0-9@._+-]{3,})"""),
          "secret": re.compile(r"""\x20*["']?([^\s"'<>,;]{8,})"""),
          "endpoint": re.compile(r"""\x20*["']?([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+(?::[0-9]{1,5})?)""")}
_KEY = re.compile(r"[A-Za-z][A-Za-z_-]*\Z")
_URL = re.compile(r"""[a-z][a-z0-9+.-]*://(?:([^\s"'<>/:@]+):([^\s"'<>/@]+)@)?[^\s"'<>]+""")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*\Z")
_TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
_SCOPE = re.compile(r"\n[\x20\t\r]*(?=\n)|^\[[^\]\n]+\][\x20\t\r]*$", re.M)
_LOOK_BACK, _SCHEME_CHARS, _ENTROPY = 64, 32, 3.5


@dataclass(frozen=True)
class Part:
    """A piece of a credential. ``named``: a key word or its format tells its role."""

    start: int
    end: int
    role: str
    kind: str
    named: bool


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """The base kinds' spans, kind by kind."""
    found = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    return found + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


def _random_looking(token: str) -> bool:
    """Whether a token has small and capital letters and digits, and many different ones."""
    if not (re.search("[a-z]", token) and re.search("[A-Z]", token) and re.search("[0-9]", token)):
        return False
    n = len(token)
    return -sum(c / n * math.log2(c / n) for c in Counter(token).values()) >= _ENTROPY


def _keyed(text: str) -> Iterator[Part]:
    done = 0
    for m in re.finditer("[:=]", text):
        if m.start() < done:  # inside the value before
            continue
        before = text[max(0, m.start() - _LOOK_BACK):m.start()].rstrip(" ")
        key = _KEY.search(before[:-1] if before[-1:] in ("'", '"') else before)
        role = key and _ROLE.get(key.group().lower().replace("_", "").replace("-", ""))
        value = role and _VALUE[role].match(text, m.end())
        if value and not (role == "secret" and (value.group(1).isalpha() or "://" in value.group(1))):
            done = value.end()
            yield Part(value.start(1), value.end(1), role, role, True)


def _urls(text: str) -> Iterator[Part]:
    at, done = text.find("://"), 0
    while at >= 0:
        scheme = _SCHEME.search(text[max(done, at - _SCHEME_CHARS):at].lower())
        m = scheme and _URL.match(text, at - (scheme.end() - scheme.start()))
        if m:
            yield Part(m.start(), m.end(), "endpoint", "endpoint", True)
            if m.group(1):
                yield Part(m.start(1), m.end(1), "ident", "ident", True)
                yield Part(m.start(2), m.end(2), "secret", "secret", True)
            done = m.end()
        at = text.find("://", max(at + 3, done))


def _bare(text: str) -> Iterator[Part]:
    for m in _TOKEN.finditer(text):
        if _random_looking(m.group()):
            yield Part(m.start(), m.end(), "secret", "secret", False)


def parts(text: str, base: list[tuple[str, int, int]]) -> list[Part]:
    """All parts by start: the base spans, and the weak candidates that overlap no earlier part of their role."""
    taken: dict[str, list[Part]] = {"ident": [], "secret": [], "endpoint": []}
    for kind, a, b in base:
        role = "ident" if kind == "access" else "secret"
        taken[role].append(Part(a, b, role, kind, kind != "hex"))
    weak = [*_urls(text), *_keyed(text)] if ":" in text or "=" in text else []
    for group in (weak, list(_bare(text))):
        # a bare token inside an address is a path
        blocked = {role: _Near(p) for role, p in taken.items()}
        new: dict[str, list[Part]] = {role: [] for role in taken}
        for p in sorted(group, key=lambda p: (p.start, -p.end)):
            last = new[p.role][-1] if new[p.role] else None
            if blocked[p.role].overlaps(p) or (last and p.start < last.end) or (not p.named and blocked["endpoint"].overlaps(p)):
                continue
            new[p.role].append(p)
        for role, found in new.items():
            taken[role] += found
    return sorted((p for found in taken.values() for p in found), key=lambda p: (p.start, p.end, KINDS.index(p.kind)))


class _Near:
    """One side of the interval join: parts by start, with the running largest end."""

    def __init__(self, side: list[Part]) -> None:
        self.side = sorted(side, key=lambda p: (p.start, p.end))
        self.starts = [p.start for p in self.side]
        self.far: list[int] = []  # the part with the largest end so far
        for i, p in enumerate(self.side):
            self.far.append(i if not i or p.end > self.side[self.far[-1]].end else self.far[-1])

    def overlaps(self, p: Part) -> bool:
        i = bisect_left(self.starts, p.end)
        return i > 0 and self.side[self.far[i - 1]].end > p.start

    def nearest(self, p: Part, reach: int) -> Part | None:
        """The part with the smallest gap to ``p``, none beyond ``reach``; of equal gaps the left one."""
        i = bisect_left(self.starts, p.end)
        found = []
        if i:
            left = self.side[self.far[i - 1]]
            found.append((max(0, p.start - left.end), 0, left))
        if i < len(self.side):
            found.append((self.side[i].start - p.end, 1, self.side[i]))
        gap, _, best = min(found, key=lambda x: x[:2], default=(reach + 1, 0, None))
        return best if gap <= reach else None


def link(found: list[Part], reach: int = REACH) -> tuple[list[Part], list[tuple[Part, Part | None, Part | None]]]:
    """Of the parts of one scope: those to report, and the credentials (secret, identifier, endpoint)."""
    by_role = {r: [p for p in found if p.role == r] for r in ("ident", "secret", "endpoint")}
    near = {r: _Near(p) for r, p in by_role.items()}
    credentials, secrets = [], []
    for s in by_role["secret"]:
        ident, endpoint = near["ident"].nearest(s, reach), near["endpoint"].nearest(s, reach)
        if ident or (endpoint and s.named):
            credentials.append((s, ident, endpoint))
        if s.kind in BASE or ident or (endpoint and s.named):
            secrets.append(s)
    whole = _Near([s for s in secrets if s.named or near["ident"].nearest(s, reach)])
    report = secrets + [p for r in ("ident", "endpoint") for p in by_role[r] if p.kind in BASE or whole.nearest(p, reach)]
    return report, credentials


def scan_text(text: str, reach: int = REACH) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]], list[tuple]]:
    """(base spans, all spans, credentials) of a text, in order of start and kind."""
    base = base_spans(text)
    ends = [m.end() for m in _SCOPE.finditer(text)]
    scopes: dict[int, list[Part]] = {}
    for p in parts(text, base):
        scopes.setdefault(bisect_right(ends, p.start), []).append(p)
    spans, credentials = list(base), []
    for scope, found in scopes.items():
        report, linked = link(found, reach)
        spans += [(p.kind, p.start, p.end) for p in report if p.kind not in BASE]
        credentials += [(scope, s, i, e) for s, i, e in linked]
    order = lambda x: (x[1], KINDS.index(x[0]))
    return sorted(base, key=order), sorted(spans, key=order), credentials


def digest(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
_CREDENTIAL = pa.struct([("scope", pa.int64()), ("secret", _SPAN), ("ident", _SPAN), ("endpoint", _SPAN)])
_SPAN_DDL = "struct<kind:string,start:bigint,end:bigint>"
SCHEMA = (f"doc_id bigint, base_spans string, spans string, found array<{_SPAN_DDL}>, "
          f"credentials array<struct<scope:bigint,secret:{_SPAN_DDL},ident:{_SPAN_DDL},endpoint:{_SPAN_DDL}>>")


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", reach: int = REACH) -> DataFrame:
    """Per document: doc_id, base_spans and spans as text, the spans ``found`` and the linked ``credentials``."""
    one = lambda p: p and {"kind": p.kind, "start": p.start, "end": p.end}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            base, every, found, linked = [], [], [], []
            for t in b.column(1).to_pylist():
                first, spans, credentials = scan_text(t or "", reach)
                base.append(digest(first))
                every.append(digest(spans))
                found.append([{"kind": k, "start": x, "end": y} for k, x, y in spans])
                linked.append([{"scope": n, "secret": one(s), "ident": one(i), "endpoint": one(e)} for n, s, i, e in credentials])
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(base, pa.string()), pa.array(every, pa.string()), pa.array(found, pa.list_(_SPAN)),
                 pa.array(linked, pa.list_(_CREDENTIAL))], names=["doc_id", "base_spans", "spans", "found", "credentials"])

    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, SCHEMA)


def credentials(docs: DataFrame, **names: str) -> DataFrame:
    """One row per linked credential: doc_id, scope, and the spans secret, ident and endpoint (null if missing)."""
    return scan(docs, **names).select("doc_id", F.inline("credentials"))
