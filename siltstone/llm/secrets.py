"""Credentials in source and configuration files.

Every place that could hold a credential (string literals with a name, call
arguments, URLs, connection strings, headers, notes in comments, settings, key
blocks) is a candidate. A logistic regression scores it on the likelihood of its
characters under two Markov chains (credentials and ordinary values), on its
spread of characters, on the words of the identifiers around it, on the place it
stands in and on the words of the path. Matches of sure patterns are its weak
labels; no feature looks at a pattern. The chains are counted over all candidates;
the regression is fitted on a bounded sample of each label, and its scores are
calibrated on a part of the sample it has not seen.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_rows

#: Labelled candidates the regression sees at most (half of each label), one in so many of them held out for
#: calibration, and the score from which a candidate is a credential.
TRAINING_ROWS, HELD_OUT, THRESHOLD = 20_000, 4, 0.5
#: Slots that words of the context and of the path are hashed into.
CONTEXT_SLOTS, PATH_SLOTS = 256, 64
#: Literals longer than this under a name without any cue are data.
DATA_LENGTH = 60
#: What counts as the surroundings of a value: short arguments before it, characters before a note, and those
#: before a string in which its name is looked for (more where a name or white space goes on).
CONTEXT_ARGUMENTS, NOTE_BEFORE, NAME_BEFORE = 3, 40, 120

_STRING = re.compile(r'"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|`[^`\n]*`')
_NAMED = re.compile(r"([A-Za-z_$][\w$.-]*)[\"'\]]*\s*(?::\s*[\w&<>\[\]?\s*]{1,40})?\s*(?:=>|:=|==?|:)\s*(?:&?\w+!\(\s*|\(\s*)?$")
_CALL = re.compile(r"([A-Za-z_][\w.:]*!?)\s*\(\s*$")
#: Between the name of a list and its first element.
_LIST = re.compile(r"([A-Za-z_$][\w$.-]*)[\"'\]]*\s*(?::\s*[\w&<>\[\];\s*]{1,40})?\s*(?:=>|:=|=|:)\s*(?:&|new\s+)?(?:[\w.]*!?(?:\[\d*\]\s*[\w.]*)?\s*[\[{]|(?:[\w.]*\b(?:of|asList|(?:list|set|array)Of|List|Set|Seq|Array|Vector))?\s*\()\s*$")
_PAIR = re.compile(r"\s*(?::|=>)")
_JOIN = re.compile(r"\s*(?:\+|\.|\\\n)?\s*$")
_URL = re.compile(r"\b[a-zA-Z][a-zA-Z0-9+.-]{1,20}://([^\s/:@\"'`]*):([^\s@/\"'`]+)@")
_CONNECTION = re.compile(r"(?i)\b((?:pwd|passw(?:or)?d|accountkey|sharedaccesskey|secret|user ?key)) ?= ?([^;\s\"'`(){}\[\]]+)(?=;|\"|')")
_NOTE = re.compile(r"(?i)(?<![a-z])(pass(?:word|wd|phrase|code)?|pwd|secret|token|(?:api|access|secret|signing)[-_ ]?key|credentials?|bearer|basic|key)\b[\"']?(?:\s+|(?=[:=]))(?:(?:is|was|are|be|:=|=>|[:=])\s*)*(?:(?:bearer|basic|token)\s+)?([^\s\"'`,;<>(){}\[\]]{6,})")
_LOGIN = re.compile(r"(?i)\b(?:login|user|account|credentials?|creds)\b:?\s+([\w.@-]+)\s*/\s*([^\s\"'`]{5,})")
_USERPASS = re.compile(r"(?:-u|--user)[ =][\"']?([^\s:\"']+):([^\s\"'`]+)")
_PREFIXED = re.compile(r"\b(?:(?:AKIA|ASIA)[A-Z0-9]{16}|[a-z]{2,6}(?:_[a-z]{2,6}){0,2}[_-](?=[A-Za-z0-9]*\d)[A-Za-z0-9]{18,}|eyJ[\w-]{10,}\.eyJ[\w-]{5,}(?:\.[\w-]+)?)(?![\w-])")
_SETTING = re.compile(r"(?m)^[ \t-]*(?:export[ \t]+)?([A-Za-z_][\w.-]*)[ \t]*[:=][ \t]*([^\s\"'#`$][^\s#]*)[ \t]*\r?$")
_PRIVATE = re.compile(r"-----BEGIN (?:[A-Z0-9]+ )*PRIVATE KEY(?: BLOCK)?-----")
_SETTING_LANGUAGES = {"yaml", "yml", "shell", "sh", "bash", "ini", "toml", "properties", "dotenv", "env"}

#: Words of identifiers that point to a credential, to something else, and forms that stand for a value to come (fixed values).
CUES = re.compile(r"(?i)pass(?:w(?:or)?d|phrase|code)?(?![a-z])|pass(?=[A-Z_0-9])|pwd|pw(?![a-z])|secret|token|api[-_ ]?key|apikey|access[-_ ]?key|signing[-_ ]?key|(?<![a-z])key(?![a-z])|cred|auth(?!or)|bearer|login|session|private[-_ ]?key")
OTHERS = re.compile(r"(?i)digest|hash|sha-?\d|sha(?![a-z])|md5|commit|checksum|revision|(?<![a-z])rev(?![a-z])|uuid|guid|(?<![a-z])(?<!key[-_ ])id(?![a-z])|etag|public|fingerprint|prompt|integrity|version|build|licen[sc]e|spdx|nonce")
PLACEHOLDER = re.compile(r"(?i)your[-_ ]|<[^>]*>|\$\{|\{\{|%\(|%[sd]$|\*{4,}|x{5,}|\.{3}|replace[-_ ]?me|change[-_ ]?(?:me|it)|example[-_ ]?(?:key|token|secret)|goes[-_ ]?here|placeholder|redacted|insert[-_ ]|put[-_ ]|todo|dummy|enter[-_ ]|^(?:password|passwd|secret|token|user|username|changeit|test|none|null|undefined|true|false)$|getenv|environ|process\.env|os\.env|vault|lookup|_here\b")
_UUID = re.compile(r"(?i)[0-9a-f]{8}-(?:[0-9a-f]{4}-){3}[0-9a-f]{12}")
_HEX = re.compile(r"(?i)(?:[0-9a-f]{2}){12,}")
_WORD = r"(?:[a-z]+|[A-Z]+|[A-Z][a-z]+)"
_PLAIN = re.compile(rf"[A-Z]{{1,6}}-\d+(?:\.\d+)*(?:-[a-z]+)*|{_WORD}(?:[ ._/:-]{_WORD})*(?:[-_.]?\d{{1,2}})?|[\d.,:/-]+")
#: Names of constants and settings, as calls have them before the value they set.
_SET_NAME = re.compile(r"[A-Za-z]{1,12}\d{0,3}(?:_[A-Za-z]{1,12}\d{0,3})+")
_CAMEL_NAME = re.compile(r"[a-z]*[aeiouy][a-z]*(?:[A-Z](?=[a-z]*[aeiouy])[a-z]{2,})+")

KINDS = ["named", "argument", "url", "connection", "note", "login", "userpass", "prefixed", "setting", "private", "header"]


def is_plain(kind: str, value: str) -> bool:
    """Words, names, versions and numbers; where a password has its fixed place, camel case is no name."""
    if _PREFIXED.fullmatch(value):
        return False
    return bool(_PLAIN.fullmatch(value)) or kind in ("named", "argument", "note", "setting") and bool(_CAMEL_NAME.fullmatch(value))


@dataclass
class Candidate:
    start: int
    end: int
    kind: str
    context: str
    value: str


#: What _NOTE and _CONNECTION begin with (fixed values).
_NOTE_WORDS = ("pass", "pwd", "secret", "token", "key", "api", "access", "signing", "credential", "bearer", "basic")
_CONNECTION_WORDS = ("pwd", "passw", "accountkey", "sharedaccesskey", "secret", "user key", "userkey")

def _notes(text: str, low: str):
    """Matches of _NOTE, tried only where one of its words stands."""
    if len(low) != len(text):
        yield from _NOTE.finditer(text)
        return
    for word in _NOTE_WORDS:
        at = low.find(word)
        while at >= 0:
            m = _NOTE.match(text, at)
            if m:
                yield m
            at = low.find(word, at + 1)


_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")


def _spoken(context: str) -> str:
    """A context with the parts of camel-case names apart."""
    return _CAMEL.sub(" ", context)


def _add(out: dict[int, Candidate], start: int, end: int, kind: str, context: str, value: str) -> None:
    known = out.get(start)
    if known is None or len(known.value) < len(value):
        out[start] = Candidate(start, end, kind, _spoken(context), value)


def _tail(gap: str) -> str:
    """The end of what stands before a string, back to where a name or white space begins."""
    start = len(gap.rstrip()) - NAME_BEFORE
    while start > 0 and (gap[start - 1].isalnum() or gap[start - 1] in "_$.-" or gap[start - 1].isspace()):
        start -= 1
    return gap[max(0, start) :]


_SCHEME = re.compile(r"(?i)^(?:authorization\s*:\s*)?(bearer|basic|token)\s+(\S{5,})$")


def candidates(text: str, language: str | None) -> list[Candidate]:
    """All places of a text that could hold a credential, in order; at most one per position."""
    out: dict[int, Candidate] = {}
    for m in _PRIVATE.finditer(text):
        _add(out, m.start(), m.end(), "private", "private key", m.group())
    name, chain, call, args = "", None, "", []
    listed = False  # name is that of a list with a cue
    last = 0
    for m in _STRING.finditer(text):
        gap = text[last : m.start()]
        body = m.group()[1:-1]
        start = m.start() + 1
        last = m.end()
        tail = _tail(gap)
        stripped = tail.strip()
        if chain and (_JOIN.match(gap) and len(gap) < 60 or (chain.context.endswith("!") and stripped == ",")):
            # a literal in parts: one value
            if " " not in body:
                chain.value += body
                chain.end = m.end() - 1
                continue
        chain = None
        if stripped == "," and (call or name):
            if args is not None:
                context, kind = " ".join([call, *[a for a in args[-CONTEXT_ARGUMENTS:] if re.fullmatch(r"[A-Za-z][\w .-]{0,24}", a)]]), "argument"
                args.append(body)
            elif listed:
                context, kind = name, "named"
            else:
                continue
        else:
            found = _NAMED.search(tail)
            inside = _LIST.search(tail)
            listed = bool(inside and CUES.search(_spoken(inside.group(1))))
            if found or listed:
                found = found or inside
                name, call, args = found.group(1), "", None
                context, kind = name + ("!" if tail.rstrip().endswith("!(") else ""), "named"
            else:
                found = _CALL.search(tail)
                if not found:
                    name, call, args = "", "", []
                    continue
                call, name, args = found.group(1), "", [body]
                if call.endswith("!"):
                    before = _NAMED.search(tail[: found.start()])
                    context, kind = (before.group(1) if before else "") + "!", "named"
                else:
                    context, kind = call, "argument"
        scheme = _SCHEME.match(body)
        if scheme:
            at = start + scheme.start(2)
            _add(out, at, at + len(scheme.group(2)), "header", f"{context} authorization {scheme.group(1)}", scheme.group(2))
            continue
        if len(body) < 5 or " " in body and not PLACEHOLDER.search(body):
            continue
        if "://" in body or ";" in body:
            continue
        if listed and _PAIR.match(text, m.end()):
            continue
        weak = listed or kind == "argument" and len(args) < 2  # keys, names and hosts stand there too
        if weak and _SET_NAME.fullmatch(body) and text[m.end() : m.end() + 1] == ",":
            continue
        if (weak or not CUES.search(_spoken(context))) and is_plain(kind, body):
            continue
        _add(out, start, m.end() - 1, kind, context, body)
        chain = out[start]
    low = text.lower()
    for m in _URL.finditer(text) if "://" in text and "@" in text else ():
        _add(out, m.start(2), m.end(2), "url", f"url password {m.group(1)}", m.group(2))
    for m in _CONNECTION.finditer(text) if any(w in low for w in _CONNECTION_WORDS) else ():
        _add(out, m.start(2), m.end(2), "connection", m.group(1), m.group(2))
    for m in _notes(text, low):
        value = m.group(2).rstrip(".:!?,") if m.group(2)[-1] in ".,:" else m.group(2)
        if is_plain("note", value) or "://" in value or "(" in value:
            continue
        _add(out, m.start(2), m.start(2) + len(value), "note", text[max(0, m.start() - NOTE_BEFORE) : m.start(2)].split("\n")[-1], value)
    for m in _LOGIN.finditer(text) if "/" in text and any(w in low for w in ("login", "user", "account", "cred")) else ():
        _add(out, m.start(2), m.end(2), "login", f"login {m.group(1)}", m.group(2))
    for m in _USERPASS.finditer(text) if "-u" in text else ():
        _add(out, m.start(2), m.end(2), "userpass", f"user {m.group(1)} password", m.group(2))
    for m in _PREFIXED.finditer(text):
        if not any(c.start <= m.start() < c.end for c in out.values()):
            _add(out, m.start(), m.end(), "prefixed", text[max(0, m.start() - NOTE_BEFORE) : m.start()].split("\n")[-1], m.group())
    if (language or "").strip().lower() in _SETTING_LANGUAGES:
        for m in _SETTING.finditer(text):
            if len(m.group(2)) >= 5 and not (is_plain("setting", m.group(2)) and not CUES.search(_spoken(m.group(1)))):
                _add(out, m.start(2), m.end(2), "setting", m.group(1), m.group(2))
    return [out[k] for k in sorted(out)]


# Features

_CLASSES = [re.compile(p) for p in ("[a-z]", "[A-Z]", r"\d", r"[^\w\s]|_")]


def _entropy(value: str) -> float:
    n = len(value)
    return -sum(k / n * math.log2(k / n) for k in map(value.count, set(value))) if n else 0.0


def _switches(value: str) -> int:
    """Changes between letters, digits and signs inside a value."""
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.isalpha() else "s" for c in value]
    return sum(a != b for a, b in zip(kinds, kinds[1:], strict=False))


def weak_label(kind: str, context: str, value: str) -> int | None:
    """1: a sure credential, 0: surely none, None: not labelled."""
    if kind == "private":
        return 1
    if PLACEHOLDER.search(value) or len(value) < 5:
        return 0
    if _UUID.fullmatch(value):
        return 0
    cue, other = bool(CUES.search(context)), bool(OTHERS.search(context))
    if other and not cue and _HEX.fullmatch(value):
        return 0
    if is_plain(kind, value):
        return 0
    if len(value) > 300 and not cue:
        return 0
    if _PREFIXED.fullmatch(value) and not other:
        return 1
    if len(value) > DATA_LENGTH and not cue and kind in ("named", "argument"):
        return 0
    mixed = sum(bool(p.search(value)) for p in _CLASSES)
    if (cue or kind in ("url", "connection", "userpass", "header")) and not other and (mixed >= 3 and len(value) >= 8 or kind in ("url", "connection", "userpass") or _HEX.fullmatch(value)):
        return 1
    return None


#: Numbers of a value by itself; kinds, context words and path words follow.
NUMBERS = 10
FEATURES = NUMBERS + len(KINDS) + CONTEXT_SLOTS + PATH_SLOTS
_PARTS = re.compile(r"[^\W\d_]+")


def _slots(text: str, first: int, slots: int) -> set[int]:
    """Slots of the words of a text, and of the first four letters of longer ones."""
    out = set()
    for word in _PARTS.findall(text):
        word = word.lower()
        for w in (word, word[:4] + "*") if len(word) > 4 else (word,):
            out.add(first + xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"), 7) % slots)
    return out


def features(kind: str, context: str, value: str, path: str | None, chains: Chains) -> dict[int, float]:
    """Features by number, zeros left out. A null path has no words."""
    n = len(value)
    gain = chains.gain(value)
    low = sum(map(str.islower, value))
    out = {
        0: 1.0,
        1: max(-4.0, min(4.0, gain)),
        2: max(-1.0, min(1.0, gain)) * min(math.log2(1 + n), 8.0) / 4.0,
        3: min(_entropy(value), 5.0) / 5.0,
        4: min(math.log2(1 + n), 10.0) / 5.0,
        5: low / n if n else 0.0,
        6: sum(map(str.isupper, value)) / n if n else 0.0,
        7: sum(map(str.isdigit, value)) / n if n else 0.0,
        8: min(_switches(value) / max(1, n - 1), 1.0),
        9: sum(bool(p.search(value)) for p in _CLASSES) / 4.0,
    }
    out[NUMBERS + KINDS.index(kind)] = 1.0
    first = NUMBERS + len(KINDS)
    for slot in _slots(context, first, CONTEXT_SLOTS) | _slots(_spoken(path or ""), first + CONTEXT_SLOTS, PATH_SLOTS):
        out[slot] = 1.0
    return {k: v for k, v in out.items() if v}


def _code(c: str) -> int:
    o = ord(c)
    return o - 32 if 32 <= o < 127 else 95


class Chains:
    """Two first-order Markov chains over printable characters, with one added to every count."""

    def __init__(self, counts: np.ndarray):
        smooth = counts.reshape(2, 96, 96) + 0.5
        self.log = np.log(smooth / smooth.sum(axis=2, keepdims=True))
        self.ratio = (self.log[1] - self.log[0]).tolist()

    def gain(self, value: str) -> float:
        """Mean log-likelihood ratio per step: credential against ordinary value."""
        codes = [_code(c) for c in value]
        if len(codes) < 2:
            return 0.0
        return sum(self.ratio[a][b] for a, b in zip(codes, codes[1:], strict=False)) / (len(codes) - 1)


CANDIDATE = "start int, `end` int, line_no int, kind string, context string, value string, weak int"


def find_candidates(files: DataFrame, keep: list[str], text: str = "content", language: str = "language") -> DataFrame:
    """One row per candidate: the columns of keep, the span in code points, its line from 1, kind, context, value, weak label."""
    types = dict(files.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [CANDIDATE])

    def make():
        def work(texts, languages, *kept):
            out = []
            for t, lang, *k in zip(texts, languages, *kept, strict=True):
                if not t:
                    continue
                line, at = 1, 0
                for c in candidates(t, lang):
                    line += t.count("\n", at, c.start)
                    at = c.start
                    out.append((*k, c.start, c.end, line, c.kind, c.context, c.value, weak_label(c.kind, c.context, c.value)))
            return out

        return work

    return map_rows(files, [text, language, *keep], schema, make)


def count_steps(found: DataFrame) -> np.ndarray:
    """Character steps of weakly labelled candidates, counted over all of them: 2 x 96 x 96 numbers."""

    def make():
        def work(labels, values):
            counts = np.zeros(2 * 96 * 96, np.int64)
            for label, value in zip(labels, values, strict=True):
                codes = [_code(c) for c in value]
                for a, b in zip(codes, codes[1:], strict=False):
                    counts[label * 9216 + a * 96 + b] += 1
            at = np.flatnonzero(counts)
            return list(zip(at.tolist(), counts[at].tolist(), strict=True))

        return work

    summed = map_rows(found.where("weak is not null and kind <> 'private'"), ["weak", "value"], "step int, n bigint", make).groupBy("step").agg(F.sum("n").alias("n"))
    counts = np.zeros(2 * 96 * 96)
    for row in summed.collect():  # at most 18,432 rows
        counts[row["step"]] = row["n"]
    return counts


def fit(rows: list[tuple[int, dict[int, float]]], rounds: int = 30, ridge: float = 0.05) -> np.ndarray | None:
    """Weights of a logistic regression by Newton steps; classes weigh the same. None where a class has no rows."""
    if len({y for y, _ in rows}) < 2:
        return None
    y = np.array([r[0] for r in rows], float)
    x = np.zeros((len(rows), FEATURES))
    for i, (_, named) in enumerate(rows):
        x[i, list(named)] = list(named.values())
    weight = np.where(y == 1, 0.5 / y.mean(), 0.5 / (1 - y.mean()))
    w = np.zeros(FEATURES)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (weight * (p - y)) + ridge * w
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + (ridge + 1e-6) * np.eye(FEATURES)
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-4:
            break
    return w


def _raw(named: dict[int, float], weights: list[float]) -> float:
    return sum(v * weights[k] for k, v in named.items())


def calibrate(raw: list[float], labels: list[int], weight: list[float], rounds: int = 50) -> tuple[float, float]:
    """Slope and offset that turn raw scores into chances, fitted to held-out rows (Platt's smoothed targets).

    weight: candidates a row stands for. Without rows of both labels scores stay as they are.
    """
    if len(set(labels)) < 2:
        return 1.0, 0.0
    z, y, w = np.array(raw), np.array(labels, float), np.array(weight)
    w = w / w.mean()
    up, down = y.sum(), (1 - y).sum()
    target = np.where(y == 1, (up + 1) / (up + 2), 1 / (down + 2))
    x = np.stack([z, np.ones(len(z))], axis=1)
    a = np.array([1.0, 0.0])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ a, -30, 30)))
        grad = x.T @ (w * (p - target)) + 1e-3 * (a - [1.0, 0.0])
        hess = (x * (w * p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 2.0 / max(1e-9, np.abs(step).max()))
        a -= step
        if np.abs(step).max() < 1e-6:
            break
    return (float(a[0]), float(a[1])) if a[0] > 0 else (1.0, 0.0)


@dataclass
class Model:
    """weights None: no regression could be fitted; then exactly the weak labels count."""

    counts: np.ndarray
    weights: list[float] | None
    slope: float = 1.0
    offset: float = 0.0

    def __post_init__(self):
        self.chains = Chains(self.counts)

    def score(self, kind: str, context: str, value: str, path: str | None) -> float:
        if kind == "private":
            return 1.0
        if self.weights is None:
            return float(weak_label(kind, context, value) == 1)
        if PLACEHOLDER.search(value) or _UUID.fullmatch(value):
            return 0.0  # no value yet, or a plain id
        z = self.slope * _raw(features(kind, context, value, path, self.chains), self.weights) + self.offset
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def train(found: DataFrame, path: str = "file_path", limit: int = TRAINING_ROWS) -> Model:
    """Counts the chains over all candidates, fits the regression and calibrates it.

    Of each weak label at most limit / 2 different candidates are taken, those with the
    least hashes, so a rare label is not crowded out; one in HELD_OUT of them only
    calibrates, weighing as many candidates as it stands for. Features are made by the
    workers, so nothing of unbounded length reaches the driver.
    """
    counts = count_steps(found)
    chains_of = counts.tolist()
    keyed = found.where("weak is not null and kind <> 'private'").withColumn("key", F.xxhash64("kind", "context", "value", path))
    keys = keyed.select("weak", "key").distinct()
    sizes = {r["weak"]: r["n"] for r in keys.groupBy("weak").agg(F.count("*").alias("n")).collect()}
    if len(sizes) < 2:
        return Model(counts, None)
    most = {y: keys.where(F.col("weak") == y).orderBy("key").limit(limit // 2).agg(F.max("key")).first()[0] for y in sizes}
    taken = keyed.where((F.col("weak") == 0) & (F.col("key") <= most[0]) | (F.col("weak") == 1) & (F.col("key") <= most[1]))

    def make():
        chains = Chains(np.array(chains_of))

        def work(labels, keys, kinds, contexts, values, paths):
            out = []
            for y, key, *c in zip(labels, keys, kinds, contexts, values, paths, strict=True):
                named = features(*c, chains)
                out.append((y, key, list(named), list(named.values())))
            return out

        return work

    sample = map_rows(taken, ["weak", "key", "kind", "context", "value", path], "weak int, key bigint, slots array<int>, amounts array<double>", make)
    rows = {(r["weak"], r["key"]): dict(zip(r["slots"], r["amounts"], strict=True)) for r in sample.dropDuplicates(["weak", "key"]).toLocalIterator()}
    rows = dict(sorted(rows.items()))
    late = [k for k in rows if k[1] % HELD_OUT == 0]
    weights = fit([(y, named) for (y, key), named in rows.items() if key % HELD_OUT])
    if weights is None:
        return Model(counts, None)
    own = weights.tolist()
    stands_for = {y: max(1.0, sizes[y] / (limit // 2)) for y in sizes}
    slope, offset = calibrate([_raw(rows[k], own) for k in late], [y for y, _ in late], [stands_for[y] for y, _ in late])
    return Model(counts, own, slope, offset)


def score(found: DataFrame, model: Model, path: str = "file_path") -> DataFrame:
    """found with the column score: the calibrated chance that the value is a credential."""
    names = found.columns
    schema = ", ".join([f"`{c}` {t}" for c, t in found.dtypes] + ["score double"])
    parts = (model.counts, model.weights, model.slope, model.offset)
    at = [names.index(c) for c in ("kind", "context", "value", path)]

    def make():
        own = Model(*parts)

        def work(*columns):
            return [(*row, own.score(*[row[i] for i in at])) for row in zip(*columns, strict=True)]

        return work

    return map_rows(found, names, schema, make)


_BODY = re.compile(r"[A-Za-z0-9+/=]{20,}")


def redact_text(text: str, spans: list[Candidate]) -> str:
    """The text with each span replaced; quotes, lines and all else stay, so that it parses as before.

    Every part of a span becomes REDACTED; the body of a private key keeps its lines.
    """
    out, last = [], 0
    for c in sorted(spans, key=lambda c: c.start):
        if c.start < last:
            continue
        if c.kind == "private":
            closing = text.find("-----END", c.end)
            closing = len(text) if closing < 0 else closing
            out.append(text[last : c.end])
            out.append(_BODY.sub(lambda m: ("REDACTED" * (len(m.group()) // 8 + 1))[: len(m.group())], text[c.end : closing]))
            last = closing
            continue
        raw = text[c.start : c.end]
        out.append(text[last : c.start])
        parts = re.split(r"(\"\s*(?:\+|,|\.)?\s*\"|'\s*(?:\+|,|\.)?\s*')", raw)
        out.append("".join(p if i % 2 else "REDACTED" for i, p in enumerate(parts)))
        last = c.end
    out.append(text[last:])
    return "".join(out)


def redact(files: DataFrame, keep: list[str], model: Model, text: str = "content", language: str = "language", path: str = "file_path", threshold: float = THRESHOLD) -> DataFrame:
    """The columns of keep with n_redacted and the redacted text of every row; null texts stay null."""
    types = dict(files.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["n_redacted int, redacted string"])
    parts = (model.counts, model.weights, model.slope, model.offset)

    def make():
        own = Model(*parts)

        def work(texts, languages, paths, *kept):
            out = []
            for t, lang, p, *k in zip(texts, languages, paths, *kept, strict=True):
                hits = [c for c in candidates(t, lang) if own.score(c.kind, c.context, c.value, p) >= threshold] if t else []
                out.append((*k, len(hits), redact_text(t, hits) if hits else t))
            return out

        return work

    return map_rows(files, [text, language, path, *keep], schema, make)
