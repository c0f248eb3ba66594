"""The licence of each source file and of each repository.

Templates are sequences of normalised tokens: the wordings of each licence's name
and the paragraphs of its text and of its notices. They stand in metric trees
under the edit distance of tokens, computed with one bit per template token; the
triangle inequality leaves out branches that cannot hold a near template, and the
difference of lengths those that cannot be near. A run of words names a licence if
its nearest template lies within a bound that grows with its length and if their
numbers agree, as a number tells versions apart. Of overlapping runs the longest
counts; "A or B" is one choice. A passage is the text of a licence if its nearest
paragraph differs in no more than a share of its tokens; runs of words inside such
a passage name nothing more.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from siltstone.llm.arrow import map_rows
from siltstone.llm.licence_texts import TEXTS
from siltstone.llm.origin import top_comment

#: Wordings per licence, in normalised tokens (fixed values).
WORDINGS = {
    "MIT": ["mit", "expat", "expat mit", "mit license", "expat license", "expat mit license"],
    "Apache-2.0": ["apache 2", "apache license 2", "apache 2 license", "apache software license 2", "asl 2", "asl 2 apache", "al 2 apache"],
    "BSD-3-Clause": ["bsd 3 clause", "bsd 3", "3 clause bsd", "bsd 3 clause license", "3 clause bsd license", "new bsd license", "modified bsd license", "revised bsd license"],
    "BSD-2-Clause": ["bsd 2 clause", "bsd 2", "2 clause bsd", "2 clause bsd license", "bsd 2 clause license", "simplified bsd license"],
    "GPL-3.0-only": ["gpl 3", "gpl 3 only", "gnu gpl 3", "gnu general public license 3", "general public license 3", "gnu gpl 3 only"],
    "GPL-3.0-or-later": ["gpl 3 or later", "gnu gpl 3 or later", "gnu general public license 3 or later", "gpl 3 or any later"],
    "GPL-2.0-only": ["gpl 2", "gpl 2 only", "gnu gpl 2", "gnu general public license 2"],
    "GPL-2.0-or-later": ["gpl 2 or later", "gnu gpl 2 or later", "gnu general public license 2 or later"],
    "AGPL-3.0-only": ["agpl 3", "agpl 3 only", "gnu agpl 3", "gnu affero general public license 3"],
    "LGPL-2.1-only": ["lgpl 2.1", "lgpl 2.1 only", "gnu lgpl 2.1", "gnu lesser general public license 2.1", "lesser general public license 2.1"],
    "LGPL-2.1-or-later": ["lgpl 2.1 or later", "gnu lgpl 2.1 or later", "gnu lesser general public license 2.1 or later"],
    "LGPL-3.0-only": ["lgpl 3", "lgpl 3 only", "gnu lgpl 3", "gnu lesser general public license 3"],
    "MPL-2.0": ["mpl 2", "mozilla public license 2", "mozilla mpl 2", "mozilla license 2"],
    "ISC": ["isc", "isc license"],
    "Unlicense": ["unlicense", "unlicense public domain dedication", "unlicense license"],
}
#: Licences that ask for the same licence on derived works (fixed values).
COPYLEFT_PREFIXES = ("GPL", "LGPL", "AGPL", "MPL")
#: Tokens that may differ between a run of words and its template.
BOUND = 1
_TOKENS_PER_ERROR = 5
#: Share of the tokens of a passage that may differ from a paragraph of a licence text, and the shortest such paragraph.
TEXT_SHARE, SHORTEST_TEXT = 0.2, 10
#: Names that are also words; in running text they count only beside one of the cues (fixed values).
AMBIGUOUS = {"mit", "isc", "expat"}
CUES = {"license", "licensed", "spdx", "identifier", "licenses"}

_WORD = re.compile(r"\d+(?:\.\d+)*|[^\W\d_]+|[()]", re.UNICODE)
_SAME = {"licence": "license", "licenced": "licensed", "licences": "licenses", "three": "3", "two": "2"}
_DROPPED = {"v", "version", "the", "(", ")"}


def normalise(text: str) -> list[str]:
    """Lower-case tokens; spellings made one, versions without a final .0, fillers dropped."""
    out = []
    for t in _WORD.findall(text.lower()):
        t = _SAME.get(t, t)
        if t.endswith("v") and len(t) > 3 and t[:-1].endswith(("pl", "bsd", "apache", "asl")):
            t = t[:-1]  # a version written to the name
        if t in _DROPPED:
            continue
        if t[0].isdigit():
            while t.endswith(".0"):
                t = t[:-2]
        out.append(t)
    return out


def token_distance(masks: dict[str, int], length: int, text: tuple[str, ...]) -> int:
    """Edit distance of a template, given as bit masks of its tokens, and a token sequence."""
    if not length:
        return len(text)
    plus, minus, score, last = (1 << length) - 1, 0, length, 1 << (length - 1)
    full = plus
    for t in text:
        eq = masks.get(t, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(xh | plus) & full
        down = plus & xh
        if up & last:
            score += 1
        elif down & last:
            score -= 1
        up = (up << 1) | 1
        plus = ((down << 1) | ~(xv | up)) & full
        minus = up & xv & full
    return score


class _Node:
    def __init__(self, tokens: tuple[str, ...], name: str):
        self.tokens, self.name = tokens, name
        self.masks: dict[str, int] = {}
        for i, t in enumerate(tokens):
            self.masks[t] = self.masks.get(t, 0) | 1 << i
        self.children: dict[int, _Node] = {}
        self.shortest = self.longest = len(tokens)


class MetricTree:
    """Templates under token edit distance."""

    def __init__(self, templates: list[tuple[tuple[str, ...], str]]):
        self.root: _Node | None = None
        self.longest, self.shortest = 0, 1 << 30
        for tokens, name in templates:
            self._add(_Node(tokens, name))

    def _add(self, node: _Node) -> None:
        self.longest, self.shortest = max(self.longest, len(node.tokens)), min(self.shortest, len(node.tokens))
        at = self.root
        if at is None:
            self.root = node
            return
        while True:
            at.shortest, at.longest = min(at.shortest, len(node.tokens)), max(at.longest, len(node.tokens))
            d = token_distance(at.masks, len(at.tokens), node.tokens)
            if d not in at.children:
                at.children[d] = node
                return
            at = at.children[d]

    def within(self, tokens: tuple[str, ...], bound: int) -> Iterator[tuple[int, _Node]]:
        """(distance, template) of all templates within a distance."""
        n = len(tokens)
        stack = [self.root] if self.root else []
        while stack:
            at = stack.pop()
            d = token_distance(at.masks, len(at.tokens), tokens)
            if d <= bound:
                yield d, at
            for k, child in at.children.items():
                if abs(k - d) <= bound and child.shortest - bound <= n <= child.longest + bound:
                    stack.append(child)


class TextIndex:
    """Paragraphs of licence texts by their length; finds the one a passage is a copy of, with small changes."""

    def __init__(self, texts: dict[str, list[str]] = TEXTS):
        templates = [(tuple(normalise(p)), name) for name, paragraphs in texts.items() for p in paragraphs]
        self.tree = MetricTree(templates)
        self.rare = self._rare(templates)

    @staticmethod
    def _rare(templates: list[tuple[tuple[str, ...], str]]) -> set[str]:
        """Words of the paragraphs, without those short ones any text has."""
        return {t for tokens, _ in templates for t in tokens if len(t) > 4}

    def nearest(self, tokens: tuple[str, ...]) -> str | None:
        """The licence whose paragraph lies nearest, within TEXT_SHARE of the passage's length."""
        n = len(tokens)
        bound = int(n * TEXT_SHARE)
        if n < SHORTEST_TEXT or n + bound < self.tree.shortest or n - bound > self.tree.longest:
            return None
        best = min(((d, node.name) for d, node in self.tree.within(tokens, bound)), default=None)
        return best[1] if best else None

    def named(self, passages: list[str]) -> tuple[set[str], set[int]]:
        """Licences whose text stands in a list of passages, and the numbers of the passages that hold it.

        A passage is tried alone and together with those that follow it, as lists of
        conditions are often set apart.
        """
        lists = [tuple(normalise(p)) for p in passages]
        names, held = set(), set()
        for i in range(len(lists)):
            # most passages share too few words with any licence text to lie near one
            if i in held or len(self.rare.intersection(lists[i])) < 3:
                continue
            joined: tuple[str, ...] = ()
            for j in range(i, len(lists)):
                joined += lists[j]
                if len(joined) * (1 - TEXT_SHARE) > self.tree.longest:
                    break
                found = self.nearest(joined)
                if found:
                    names.add(found)
                    held.update(range(i, j + 1))
        # the conditions of the longer licence begin with those of the shorter one
        return names - {"BSD-2-Clause"} if "BSD-3-Clause" in names else names, held


class TemplateTree:
    """Wordings of the names of licences."""

    def __init__(self, wordings: dict[str, list[str]] = WORDINGS):
        self.tree = MetricTree([(tuple(text.split()), name) for name, texts in wordings.items() for text in texts])
        self.longest = self.tree.longest
        self.memory: dict[tuple[str, ...], tuple[int, str] | None] = {}
        self.vocabulary = {t for texts in wordings.values() for text in texts for t in text.split()}

    def nearest(self, tokens: tuple[str, ...]) -> tuple[int, str] | None:
        """(distance, licence) of the nearest template within the bound of this length."""
        if tokens in self.memory:
            return self.memory[tokens]
        bound = min(BOUND, len(tokens) // _TOKENS_PER_ERROR)
        numbers = [t for t in tokens if t[0].isdigit()]
        near = [(d, node.name) for d, node in self.tree.within(tokens, bound) if [t for t in node.tokens if t[0].isdigit()] == numbers]
        best = min(near, default=None)
        if len(self.memory) > 200_000:
            self.memory.clear()
        self.memory[tokens] = best
        return best

    def named(self, tokens: list[str], alone: bool = False) -> list[str]:
        """Licences named in a token sequence, sorted; alone: the sequence is a name by itself."""
        known = self.vocabulary
        spans = []
        for i, t in enumerate(tokens):
            if t not in known:
                continue
            for n in range(1, min(self.longest + BOUND, len(tokens) - i) + 1):
                if tokens[i + n - 1] not in known:
                    continue
                found = self.nearest(tuple(tokens[i : i + n]))
                if found:
                    spans.append((-n, found[0], i, found[1]))
        if not spans:
            return []
        cue = alone or not CUES.isdisjoint(tokens)
        taken: list[tuple[int, int, str]] = []
        for minus, _, i, name in sorted(spans):
            n = -minus
            if n == 1 and not cue and tokens[i] in AMBIGUOUS:
                continue
            if all(i + n <= a or i >= b for a, b, _ in taken):
                taken.append((i, i + n, name))
        taken.sort()
        names: list[list[str]] = []
        end = None
        for a, b, name in taken:
            between = tokens[end:a] if end is not None else None
            if between is not None and [t for t in between if t != "license"] == ["or"]:
                names[-1].append(name)
            else:
                names.append([name])
            end = b
        return sorted({" OR ".join(sorted(set(x))) for x in names})


@cache
def _tree() -> TemplateTree:
    return TemplateTree()


@cache
def _texts() -> TextIndex:
    return TextIndex()


_STATEMENTS: dict[tuple[str, bool], list[str]] = {}
#: Longer statements are not remembered: hardly one comes again, and many would fill the memory.
_REMEMBERED = 10_000


def statement_names(text: str, alone: bool = False) -> list[str]:
    if len(text) > _REMEMBERED:
        return _tree().named(normalise(text), alone)
    known = _STATEMENTS.get((text, alone))
    if known is None:
        if len(_STATEMENTS) > 100_000:
            _STATEMENTS.clear()
        known = _STATEMENTS[text, alone] = _tree().named(normalise(text), alone)
    return known


def header_names(text: str | None) -> list[str]:
    """Licences named, or given by their text, in the comment a file begins with."""
    if not text:
        return []
    if "\r" in text:
        text = text.replace("\r\n", "\n").replace("\r", "\n")
    lines = top_comment(text)
    passages = _passages(lines)
    names, held = _texts().named(passages) if len(passages) > 1 or sum(map(len, passages)) > 60 else (set(), set())
    if not held:
        return statement_names(" ".join(lines))
    return sorted({*names, *statement_names(" ".join(p for i, p in enumerate(passages) if i not in held))})


def _passages(lines: list[str]) -> list[str]:
    """Lines joined to paragraphs; empty ones, and rows of signs, part them."""
    out: list[list[str]] = [[]]
    for line in lines:
        if re.search(r"\w", line):
            out[-1].append(line)
        elif out[-1]:
            out.append([])
    return [" ".join(p) for p in out if p]


def licence_file_names(text: str | None) -> list[str]:
    """Licences named in a licence file: in any paragraph, or as a line by itself; or given by its text."""
    lines = [line.strip() for line in (text or "").replace("\r\n", "\n").replace("\r", "\n").split("\n")]
    passages = _passages(lines)
    names, held = _texts().named(passages)
    for i, p in enumerate(passages):
        if i not in held:
            names.update(statement_names(p))
    for line in lines:
        tokens = normalise(line)
        if 0 < len(tokens) <= 2:
            names.update(statement_names(line, alone=True))
    return sorted(names)


def declared_names(values: list[str | None] | None) -> list[str]:
    """Licences of a list of identifiers; identifiers that name none are left out."""
    return sorted({n for v in values or [] if v for n in statement_names(v, alone=True)})


def is_licence_file(path: Column) -> Column:
    """LICENSE, LICENCE or COPYING, any case and extension, in the root directory."""
    return path.rlike(r"(?i)^(?:\./)?(?:licen[sc]e|copying)(?:\.[^/]*)?$")


def file_evidence(files: DataFrame, keep: list[str], text: str = "content", declared: str = "detected_licenses") -> DataFrame:
    """The columns of keep with names: licences in the top comment and in the declared list."""
    types = dict(files.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["names array<string>"])

    def make():
        def work(texts, lists, *kept):
            return [(*k, sorted({*header_names(t), *declared_names(d)})) for t, d, *k in zip(texts, lists, *kept, strict=True)]

        return work

    return map_rows(files, [text, declared, *keep], schema, make)


def repo_evidence(snapshots: DataFrame) -> DataFrame:
    """repo_id, repo_names: licences of the root licence files of each repository's latest snapshot.

    Snapshots taken at the same latest time count together; repositories without a
    licence file have an empty list; snapshots without a time are older than all others.
    """
    texts = F.transform(F.filter("files", lambda f: is_licence_file(f["file_path"])), lambda f: f["content"])
    slim = snapshots.where("repo_id is not null").select("repo_id", F.coalesce("snapshot_at", F.lit("0001-01-01").cast("timestamp")).alias("snapshot_at"), F.coalesce(texts, F.array().cast(ArrayType(StringType()))).alias("texts"))

    def make():
        def work(repos, times, lists):
            return [(r, t, sorted({n for x in xs for n in licence_file_names(x)})) for r, t, xs in zip(repos, times, lists, strict=True)]

        return work

    named = map_rows(slim, ["repo_id", "snapshot_at", "texts"], "repo_id string, snapshot_at timestamp, names array<string>", make)
    at_once = named.groupBy("repo_id", "snapshot_at").agg(F.array_distinct(F.flatten(F.collect_set("names"))).alias("names"))
    return at_once.groupBy("repo_id").agg(F.max_by("names", "snapshot_at").alias("repo_names"))


def _verdict(names: Column, kind: Column | None = None) -> Column:
    one = F.element_at(names, 1)
    conflict = F.size(names) > 1
    if kind is not None:
        copyleft = F.lit(False)
        for prefix in COPYLEFT_PREFIXES:
            copyleft = copyleft | one.startswith(prefix)
        unfit = ((kind == "permissive") & copyleft) | ((kind == "copyleft") & ~copyleft)
        conflict = conflict | F.coalesce(unfit, F.lit(False))
    return F.when(F.size(names) == 0, "unknown").when(conflict, "conflict").otherwise(one)


def file_verdicts(evidence: DataFrame, repos: DataFrame, salts: int = 16) -> DataFrame:
    """document_id, repo_id, verdict per file row.

    evidence: file_evidence() with document_id, repo_id, license_type. The files of one
    repository are spread over salts keys, as one repository may hold a third of all files;
    the evidence of a repository is one short row, repeated once per salt.
    """
    left = evidence.withColumn("salt", F.pmod(F.xxhash64("document_id"), F.lit(salts)).cast("int"))
    right = repos.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    names = F.array_union("names", F.coalesce("repo_names", F.array().cast(ArrayType(StringType()))))
    return left.join(right, ["repo_id", "salt"], "left").select("document_id", "repo_id", _verdict(names, F.col("license_type")).alias("verdict"))


def repo_verdicts(files: DataFrame, repos: DataFrame) -> DataFrame:
    """repo_id, verdict of every repository that has files or snapshots."""
    known = files.where("repo_id is not null").select("repo_id").distinct()
    joined = known.join(repos, "repo_id", "full_outer")
    return joined.select("repo_id", _verdict(F.coalesce("repo_names", F.array().cast(ArrayType(StringType())))).alias("verdict"))
