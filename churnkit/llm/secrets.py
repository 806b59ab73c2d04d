"""Secret scans: fixed patterns, and literals that assignments tie to sensitive names."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from churnkit.llm.common import map_batches, text_of

# The base patterns and their least lengths.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
MIN_VALUE, MIN_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "literal", "piece")

# Words of a target name and how much they say that its value is a secret.
NAME_WEIGHT = {"password": 3, "passwd": 3, "pwd": 3, "passphrase": 3, "pass": 2, "pw": 2, "secret": 3, "secrets": 3, "token": 3,
               "apikey": 3, "credential": 3, "credentials": 3, "cred": 2, "auth": 2, "bearer": 3, "signing": 2, "webhook": 1,
               "passcode": 3, "pin": 1, "salt": 1, "jwt": 3, "authorization": 3}
PAIR_WEIGHT = {("api", "key"): 3, ("access", "key"): 3, ("private", "key"): 3, ("secret", "key"): 3, ("encryption", "key"): 3,
               ("account", "key"): 3, ("master", "key"): 3, ("signing", "key"): 3, ("connection", "string"): 2, ("pass", "word"): 3}
# A name that ends so speaks about a secret rather than holding one.
DESCRIBES = frozenset("length len count name id url uri path file type hint label field policy expires expiry ttl format header "
                      "prefix suffix size limit regex pattern error message text title placeholder prompt env".split())
PLACEHOLDER = re.compile(r"(?i)^(?:x+|\*+|\.+|-+|<.*>|\[.*\]|\{.*\}|\$\{?\w+\}?|%\w+%|none|null|true|false|nil|undefined|todo|"
                         r"(?:your|my|the|some|insert|enter|change)[-_ ]?\w*|changeme|example\w*|redacted|test|dummy|sample)$")
THRESHOLD = 5
MIN_LITERAL = 6

# Every name that has a weight holds one of these: the weighted words, and the last word of each pair.
_STEMS = tuple(sorted({w.encode() for w in (*NAME_WEIGHT, *(pair[-1] for pair in PAIR_WEIGHT))}))
_STEMS = tuple(s for s in _STEMS if not any(o != s and o in s for o in _STEMS))
_ASSIGN_STEMS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_TOKEN = re.compile(r"""
    (?P<text>"(?:\\.|[^"\\\n])*"|'(?:\\.|[^'\\\n])*'|`[^`\n]*`)
  | (?P<name>[A-Za-z_$][\w$]*(?:[.-][A-Za-z_][\w$]*)*)
  | (?P<op>:=|=>|==|!=|<=|>=|=~|\+=|=|:|\+)
  | (?P<line>\n)
  | (?P<other>[^\s\w]|\d[\w.]*|\w)
""", re.X)
_BARE = re.compile(r"[^\S\n]*([^\s\"'`,;(){}\[\]#][^\s\"'`,;(){}\[\]]*)[^\S\n]*(?:[;,]?[^\S\n]*(?:\#[^\n]*)?)(?=\n|\Z)")
_WORD = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_USE = re.compile(r"\$?\{(\w+)\}")


@dataclass(frozen=True)
class Value:
    """What a name stands for: its text, and where the literals that make it up lie."""

    text: str
    spans: tuple[tuple[int, int], ...]


def name_score(name: str) -> int:
    """How much a target name says that its value is secret."""
    words = [w.lower() for w in _WORD.findall(name)]
    score = max([0, *(NAME_WEIGHT.get(w, 0) for w in words), *(PAIR_WEIGHT.get(p, 0) for p in zip(words, words[1:], strict=False))])
    return score - 3 if words and words[-1] in DESCRIBES else score


def literal_score(text: str) -> int:
    """How much a literal looks like a secret: length, mixture of characters, entropy."""
    n = len(text)
    if n < MIN_LITERAL or PLACEHOLDER.match(text):
        return -9
    entropy = -sum(c / n * math.log2(c / n) for c in Counter(text).values())
    classes = sum(map(bool, (re.search(r"[a-z]", text), re.search(r"[A-Z]", text), re.search(r"\d", text), re.search(r"[^\w\s]", text))))
    return (entropy >= 2.5) + (entropy >= 3.5) + (n >= 16) + (classes >= 2) + (classes >= 3) - 3 * bool(re.search(r"\s", text))


def assignments(text: str) -> list[tuple[str, Value]]:
    """(target name, value) pairs of source or configuration syntax, in order.

    Understood are ``name = value``, ``name := value``, ``"name": value``, ``name: Type = value``, ``name => value``,
    ``key="name" value="…"``, unquoted values that end their line, and values made by ``+``, by names assigned before and by
    ``${name}`` in a literal. A call is no constant, nor is a comparison an assignment.
    """
    tokens = [(m.lastgroup, m.start(), m.end()) for m in _TOKEN.finditer(text)]
    known: dict[str, Value] = {}
    found: list[tuple[str, Value]] = []
    named = ""  # from key="name", for the value="…" after it

    def literal(start: int, end: int) -> Value:
        body = text[start + 1:end - 1]
        parts = tuple(s for u in _USE.findall(body) if u in known for s in known[u].spans)
        if not parts:
            return Value(body, ((start + 1, end - 1),))
        whole = _USE.sub(lambda m: known[m[1]].text if m[1] in known else m[0], body)
        return Value(whole, (*parts, (start + 1, end - 1)))

    def operand(i: int) -> Value | None:
        if i >= len(tokens):
            return None
        kind, start, end = tokens[i]
        if kind == "text":
            return literal(start, end)
        if kind == "name" and not (i + 1 < len(tokens) and text[tokens[i + 1][1]] in "(["):
            return known.get(text[start:end])
        return None

    i = 0
    while i < len(tokens):
        kind, start, end = tokens[i]
        i += 1
        if kind not in ("name", "text") or i >= len(tokens) or tokens[i][0] != "op":
            continue
        target = text[start:end].strip("\"'`")
        op = text[tokens[i][1]:tokens[i][2]]
        if op == ":" and i + 2 < len(tokens) and tokens[i + 1][0] == "name" and text[tokens[i + 2][1]:tokens[i + 2][2]] == "=":
            i += 2  # an annotated name
            op = "="
        if op not in ("=", ":=", ":", "=>", "+="):
            continue
        value = operand(i + 1)
        after = i + 2
        if value is None:
            bare = _BARE.match(text, tokens[i][2])
            line = text[text.rfind("\n", 0, start) + 1:start]
            if bare and not line.strip().removeprefix("export").removeprefix("-").removeprefix("set").strip():
                known[target] = Value(bare[1], (bare.span(1),))
                found.append((target, known[target]))
            continue
        while after + 1 < len(tokens) and text[tokens[after][1]:tokens[after][2]] == "+" and (more := operand(after + 1)):
            value = Value(value.text + more.text, value.spans + more.spans)
            after += 2
        if op == "+=" and target in known:
            value = Value(known[target].text + value.text, known[target].spans + value.spans)
        known[target] = value
        if target.lower() in ("key", "name") and kind == "name":
            named = value.text
        elif target.lower() == "value" and named:
            found.append((named, value))
            named = ""
        found.append((target, value))
        # what is assigned may itself be a target: a = b = "…"
        i = after - 1 if tokens[after - 1][0] == "name" else after
    return found


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the fixed patterns, leftmost and without overlap within a kind."""
    out = []
    lower = text.encode("utf-8", "surrogatepass").lower()
    if any(s in lower for s in _ASSIGN_STEMS):
        out += [(*m.span(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= MIN_VALUE]
    if "AKIA" in text:
        out += [(*m.span(), "access") for m in ACCESS.finditer(text) if len(m[0]) >= MIN_ACCESS]
    out += [(*m.span(), "hex") for m in HEX.finditer(text)]
    return sorted(out, key=_place)


def _place(span: tuple[int, int, str]) -> tuple[int, int]:
    return span[0], KINDS.index(span[2])


def scan(text: str) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """(base spans, all spans) of a text. The method adds each literal that a sensitive name gets, by itself or through
    constants, unless a base span holds it. Only the joined value has to be long enough; its parts shorter than that are of
    kind ``piece``."""
    base = base_spans(text)
    if ("=" not in text and ":" not in text) or not any(s in text.encode("utf-8", "surrogatepass").lower() for s in _STEMS):
        return base, base
    more = set()
    for target, value in assignments(text):
        weight = name_score(target)
        if weight > 0 and weight + literal_score(value.text) >= THRESHOLD:
            more |= {s for s in value.spans if s[1] > s[0]}
    extra = [(s, e, "literal" if e - s >= MIN_LITERAL else "piece") for s, e in more if not any(a <= s and e <= b for a, b, _ in base)]
    return base, sorted(base + extra, key=lambda s: (*_place(s), s[1]))


def written(spans: list[tuple[int, int, str]]) -> str:
    """Spans as kind:start:end, joined by commas."""
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def find_secrets(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts and spans of the secrets in its whole text.

    n_assign, n_access and n_hex count base spans; base_sha256 is the digest of these as written; spans lists all, those of
    kind ``literal`` added by the assignment-aware scan. Offsets are code points, ends exclusive. A null or empty text has no
    spans; null and repeated keys pass through, a row each; an empty table gives none; other columns are not read.
    """
    kind = docs.schema[key].dataType.simpleString()

    def run(batches):
        for b in batches:
            found = [scan(t) for t in b["text"]]
            counts = [Counter(k for _, _, k in base) for base, _ in found]
            yield {"key": b["key"], "n_assign": [c["assign"] for c in counts], "n_access": [c["access"] for c in counts],
                   "n_hex": [c["hex"] for c in counts],
                   "base_sha256": [hashlib.sha256(written(base).encode()).hexdigest() for base, _ in found],
                   "spans": [written(spans) for _, spans in found],
                   "n_literal": [len(spans) - len(base) for base, spans in found]}

    schema = f"key {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_literal long"
    return map_batches(docs.select(F.col(key).alias("key"), text_of(text).alias("text")), run, schema).withColumnRenamed("key", key)


def mask(text: str, sign: str = "[secret]") -> str:
    """The text with every secret span, overlapping ones as one, replaced by ``sign``."""
    out, at = [], 0
    spans = sorted(scan(text)[1])
    while spans:
        start, end, _ = spans.pop(0)
        while spans and spans[0][0] < end:
            end = max(end, spans.pop(0)[1])
        out += [text[at:start], sign]
        at = end
    return "".join([*out, text[at:]])


def mask_secrets(docs: DataFrame, text: str = "text", size: str | None = "n_chars") -> DataFrame:
    """``docs`` with secrets masked in ``text``; ``size``, if such a column is there, becomes the length of a changed text.
    A null text stays null."""
    at = docs.columns.index(text)
    sized = docs.columns.index(size) if size in docs.columns else None

    def run(batches):
        for b in batches:
            old = b.column(at).to_pylist()
            new = [t if t is None else mask(t) for t in old]
            if new != old:
                b = b.set_column(at, b.schema.field(at), pa.array(new, b.schema.field(at).type))
                if sized is not None:
                    kept = b.column(sized).to_pylist()
                    b = b.set_column(sized, b.schema.field(sized), pa.array(
                        [k if n == o else len(n) for k, n, o in zip(kept, new, old, strict=True)], b.schema.field(sized).type))
            yield b

    return docs.mapInArrow(run, docs.schema)
