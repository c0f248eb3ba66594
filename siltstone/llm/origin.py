"""Source files that nobody wrote by hand for their repository.

The tokens of each file (runs of digits masked) get a Re-Pair grammar. Much
reuse of rules means a machine wrote the file from templates; literals whose
own grammar saves next to nothing are data kept as code; a start rule or a long
rule met in several repositories is a copied text. Which copied texts are those of
third parties is told by the path, the recorded flag and the comment at the top of
any of their files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_rows
from siltstone.llm.repair import pair_up, run_marks

#: Below this grammar size per token a file of MIN_TOKENS tokens or more is made from templates.
TEMPLATE_RATIO, MIN_TOKENS = 0.39, 40
#: Share of the characters in literal data from which a file is data; literals of a row, and the length and
#: the grammar ratio from which one string without blanks is data.
DATA_SHARE, ROW_LITERALS, LONG_STRING, BLOB_RATIO = 0.55, 4, 120, 0.8
#: A line this long with this small a share of blanks, literals aside, is minified.
LONG_LINE, BLANK_SHARE = 300, 0.12
#: Rules and runs of this many tokens are compared between repositories; a run is looked up by the least hash of MARK_TOKENS in it.
SHARED_TOKENS, MARK_TOKENS = 48, 32
#: Directories that hold third-party copies, whole names without case (fixed values).
THIRD_PARTY_DIRECTORIES = ["bower_components", "contrib", "deps", "external", "node_modules", "pods", "third-party", "third_party", "thirdparty", "vendor", "vendored"]

_TOKEN = re.compile(r'"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'|[^\W\d]\w*|\d[\w.]*|[^\w\s]')
_DIGITS = re.compile(r"\d+")
_STRING = re.compile(r'"(?:[^"\\\n]|\\.)*"|\'(?:[^\'\\\n]|\\.)*\'')
_COMMENT_LINE = re.compile(r"\s*(?://+|#(?!\s*include\b)|--|;|/\*+!?|\*+/?|<!--|\"\"\"|%)\s?(.*)")
_GENERATED = re.compile(
    r"""@generated\b | <auto-?generated | \bcode\ generated\ (?:by|from)\b
    | ^\W*(?:this\ (?:file|code)\ (?:was|is|has\ been)\ )?(?:auto(?:matically)?[-\ ]?generated|generated\ automatically|machine[-\ ](?:made|generated|written))\b(?!\s+\w+\s+for\b)(?=.*\b(?:from|by|with|using|file|code|grammar|run)\b|\W*$)
    | ^\W*generated\ (?:from|by|with|using)\b | \b(?:was|is|been)\ (?:produced|generated|created|written)\ automatically\b | \bautomatically\ (?:generated|produced|created)\ (?:by|from|with)\b
    | \bautomatisch\ (?:erzeugt|generiert|erstellt)\b | \bgenerado\ autom[aá]ticamente\b | \bg[eé]n[eé]r[eé]\ automatiquement\b
    | \bdo\ not\ (?:edit|modify)(?:\ (?:this\ file|by\ hand|manually))?\s*[.!;]*\s*$""",
    re.IGNORECASE | re.VERBOSE,
)
_COPIED = re.compile(
    r"""^\W*vendored\ (?:copy\ )?(?:from|of|in\ from)\b | ^\W*bundled\ (?:copy|version)\ of\b | \bupstream\ source,?\s+imported\b | \bimported\ (?:unchanged|unmodified|as\ is|verbatim)\b
    | \b(?:taken|copied)\ (?:unchanged\ |verbatim\ |unmodified\ )?from\ upstream\b | ^\W*(?:copied|imported)\ (?:verbatim|unchanged|unmodified)?\s*from\ https?:// | ^\W*third[-\ ]party\ (?:copy|source|code)\b""",
    re.IGNORECASE | re.VERBOSE,
)


def _lines(text: str) -> Iterator[str]:
    """The lines of a text one by one, so that only those that are asked for are cut out."""
    start = 0
    while (end := text.find("\n", start)) >= 0:
        yield text[start:end]
        start = end + 1
    yield text[start:]


def top_comment(text: str) -> list[str]:
    """Lines of the comment a text begins with, markers removed, however long; blank lines and an opening tag don't end it."""
    out = []
    block = False
    for raw in _lines(text):
        line = raw.strip()
        if not line or line.startswith(("#!", "<?php", "<?xml")) and not line.startswith("<?php /"):
            continue
        if block:
            out.append(line.removesuffix("*/").lstrip("* ").strip())
            block = "*/" not in line
            continue
        m = _COMMENT_LINE.match(line)
        if not m:
            break
        body = m.group(1)
        if line.startswith("/*"):
            block = "*/" not in line
            head, closed, rest = body.partition("*/")
            out.append(head.strip())
            if closed and rest.strip():
                break
            continue
        out.append(body.strip())
    return out


#: Kinds of tokens, kept in the low bits of their hash.
_OTHER, _LITERAL, _SEPARATOR, _LONG = range(4)


class _Hashes(dict):
    """Hash of each token with its digits masked (long literals are one kind), its low bits the kind."""

    def __missing__(self, token: str) -> int:
        if len(self) > 500_000:
            self.clear()
        first, kind = token[0], _OTHER
        if first in "\"'" and len(token) > 7 and not any(map(str.isspace, token)):
            kind = _LONG if len(token) > LONG_STRING else _LITERAL
        elif first.isdigit():
            kind = _LITERAL
        elif token in (",", ";", "-", "+"):
            kind = _SEPARATOR
        shape = '"' if first in "\"'" and len(token) >= 20 else _DIGITS.sub("0", token)
        h = xxhash.xxh3_64_intdigest(shape.encode("utf-8", "surrogatepass"), 2) & ~3 | kind
        if len(token) < 200:
            self[token] = h
        return h


def literal_chars(lists: list[list[str]], flat: np.ndarray, sizes: np.ndarray, owner: np.ndarray) -> np.ndarray:
    """Characters of each text in rows of literals and in long strings whose own grammar saves little."""
    out = np.zeros(len(lists), np.int64)
    if not len(flat):
        return out
    kind = (flat & np.uint64(3)).astype(np.int8)
    inside = kind != _OTHER
    edge = np.flatnonzero(np.r_[True, (inside[1:] != inside[:-1]) | (owner[1:] != owner[:-1])])
    literals = np.add.reduceat(((kind == _LITERAL) | (kind == _LONG)).astype(np.int64), edge)
    row = inside[edge] & (literals >= ROW_LITERALS)
    out += np.bincount(owner[edge[row]], weights=np.add.reduceat(sizes, edge)[row], minlength=len(lists)).astype(np.int64)
    in_row = np.repeat(row, np.diff(np.r_[edge, len(flat)]))
    base = np.cumsum([0, *map(len, lists)])
    for i in np.flatnonzero((kind == _LONG) & ~in_row).tolist():
        text = lists[owner[i]][i - base[owner[i]]]
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.uint64)
        if pair_up(chars, np.array([len(chars)])).ratio[0] >= BLOB_RATIO:
            out[owner[i]] += len(text)
    return out


def is_minified(text: str) -> bool:
    for line in text.split("\n"):
        if len(line) >= LONG_LINE:
            bare = _STRING.sub("", line)
            if len(bare) >= LONG_LINE and bare.count(" ") + bare.count("\t") < BLANK_SHARE * len(bare) and sum(map(bare.count, "(){};=")) > 0.08 * len(bare):
                return True
    return False


ORIGIN = "n_tokens int, grammar_ratio double, literal_share double, generated boolean, minified boolean, literal_data boolean, copied boolean, file_rule bigint"


def _distinct(owner: np.ndarray, values: np.ndarray, n: int) -> list[list[int]]:
    """The distinct values of each of n owners, who come in order."""
    own = np.split(values.view(np.int64), np.searchsorted(owner, np.arange(1, n)))
    return [np.unique(v).tolist() for v in own]


def measure(files: DataFrame, keep: list[str], text: str = "content", marks: bool = False, rules: bool = True) -> DataFrame:
    """The columns of keep with the evidence in the text of each file.

    generated: the top comment says so, or the grammar has TEMPLATE_RATIO symbols a token
    or fewer. minified, literal_data, copied (by the top comment) as described above.
    file_rule: hash of the start rule, null for texts without tokens; long_rules: hashes
    of the rules of SHARED_TOKENS tokens or more, where rules is set. marks: with the marks
    of the runs of SHARED_TOKENS tokens, for shared_runs(). Null and blank texts show nothing.
    """
    types = dict(files.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [ORIGIN] + ["long_rules array<bigint>"] * rules + ["marks array<bigint>"] * marks)

    def make():
        hashes = _Hashes()
        look = hashes.__getitem__

        def some(texts):
            lists = [_TOKEN.findall(t) if t else [] for t in texts]
            lengths = np.fromiter(map(len, lists), dtype=np.int64, count=len(lists))
            flat = np.fromiter((look(t) for ts in lists for t in ts), dtype=np.uint64, count=int(lengths.sum()))
            sizes = np.fromiter((len(t) for ts in lists for t in ts), dtype=np.int64, count=len(flat))
            owner = np.repeat(np.arange(len(lists)), lengths)
            data = literal_chars(lists, flat, sizes, owner)
            printed = np.bincount(owner, weights=sizes, minlength=len(lists))
            g = pair_up(flat, lengths)
            ratio = g.ratio.tolist()
            more: list[tuple] = [()] * len(texts)
            if rules:
                long: list[set[int]] = [set() for _ in texts]
                far = g.rule_length >= SHARED_TOKENS
                for owner, h in zip(g.rule_owner[far].tolist(), g.rule_hash[far].view(np.int64).tolist(), strict=True):
                    long[owner].add(h)
                more = [(sorted(own),) for own in long]
            if marks:
                whose, _, mark = run_marks(flat, lengths, SHARED_TOKENS, MARK_TOKENS)
                more = [(*m, own) for m, own in zip(more, _distinct(whose, mark, len(texts)), strict=True)]
            out = []
            for i, t in enumerate(texts):
                n = int(lengths[i])
                if not n:
                    out.append((0, 1.0, 0.0, False, False, False, False, None, *more[i]))
                    continue
                if "\r" in t:
                    t = t.replace("\r\n", "\n").replace("\r", "\n")
                head = top_comment(t)
                share = float(data[i] / printed[i])
                made = (n >= MIN_TOKENS and ratio[i] <= TEMPLATE_RATIO) or any(map(_GENERATED.search, head))
                out.append((n, ratio[i], share, bool(made), is_minified(t), share >= DATA_SHARE, any(map(_COPIED.search, head)), int(g.whole[i].view(np.int64)), *more[i]))
            return out

        def work(texts, *kept):
            rows, start, filled = [], 0, 0
            for i, t in enumerate(texts):
                filled += len(t or "")
                if filled > 1_000_000 or i - start == 1000:
                    rows += some(texts[start : i + 1])
                    start, filled = i + 1, 0
            rows += some(texts[start:])
            return [(*k, *r) for r, *k in zip(rows, *kept, strict=True)]

        return work

    return map_rows(files, [text, *keep], schema, make)


def path_is_third_party(path: Column) -> Column:
    """A directory of the path has one of the names of third-party folders."""
    parts = F.split(F.lower(F.regexp_replace(path, r"\\", "/")), "/")
    folders = F.slice(parts, 1, F.greatest(F.size(parts) - 1, F.lit(0)))
    return F.coalesce(F.arrays_overlap(folders, F.array(*map(F.lit, THIRD_PARTY_DIRECTORIES))), F.lit(False))


def classify(measured: DataFrame, path: str = "file_path", flag: str = "is_vendor", repo: str | None = None) -> DataFrame:
    """Adds third_party and hand_written. Null paths and flags are no evidence by themselves.

    repo: the column of the repository, for copies_shown_elsewhere(). measured is then read
    more than once, so it should be stored.
    """
    third = F.col("copied") | path_is_third_party(F.col(path)) | F.coalesce(F.col(flag), F.lit(False))
    told = measured.withColumn("third_party", third)
    if repo is not None:
        told = copies_shown_elsewhere(told, flag, repo)
    return told.withColumn("hand_written", ~(F.col("third_party") | F.col("generated") | F.col("minified") | F.col("literal_data")))


def copies_shown_elsewhere(told: DataFrame, flag: str = "is_vendor", repo: str = "repo_id") -> DataFrame:
    """third_party set too for files without a recorded flag whose text is a third-party copy's in another repository.

    Texts are compared by their start rules, from SHARED_TOKENS tokens; what these mask (digits,
    the content of strings of 20 characters or more) may differ. A recorded flag stands,
    and a text that no file shows to be a third party's stays hand-written, in however many
    repositories it is met.
    """
    compared = F.coalesce(F.col("n_tokens") >= SHARED_TOKENS, F.lit(False))
    shown = told.where(compared & F.col("third_party")).groupBy("file_rule").agg(F.min(repo).alias("_first"), F.max(repo).alias("_last"))
    unsure = compared & ~F.col("third_party") & F.col(flag).isNull()
    elsewhere = F.coalesce((F.col("_first") != F.col(repo)) | (F.col("_last") != F.col(repo)), F.lit(False))
    met = told.where(unsure).join(shown, "file_rule", "left").withColumn("third_party", elsewhere)
    return told.where(~unsure).unionByName(met.select(*told.columns))


def shared_runs(files: DataFrame, measured: DataFrame, key: str = "document_id", repo: str = "repo_id", text: str = "content") -> DataFrame:
    """key, runs: hashes of the runs of SHARED_TOKENS tokens that may stand in two repositories.

    measured: one row per key, with marks. Only texts with a mark met in two repositories
    are read again, and only runs with such a mark are listed: no shared run is lost, and of
    two files that hold it both list it. Runs in one repository only may be listed too.
    """
    marks = measured.select(F.xxhash64(key).alias("id"), F.xxhash64(repo).alias("r"), F.explode("marks").alias("mark"))
    met = marks.groupBy("mark").agg(F.min("r").alias("a"), F.max("r").alias("b")).where("a < b").select("mark")
    own = marks.select("id", "mark").join(met, "mark").groupBy("id").agg(F.collect_set("mark").alias("met"))
    again = files.where(F.col(text).isNotNull()).select(F.xxhash64(key).alias("id"), key, text).join(own, "id")

    def make():
        look = _Hashes().__getitem__

        def work(texts, mets, keys):
            out = []
            for t, met, k in zip(texts, mets, keys, strict=True):
                flat = np.fromiter(map(look, _TOKEN.findall(t)), dtype=np.uint64)
                _, run, mark = run_marks(flat, np.array([len(flat)]), SHARED_TOKENS, MARK_TOKENS)
                hit = np.isin(mark.view(np.int64), np.array(met, np.int64))
                out.append((k, np.unique(run[hit].view(np.int64)).tolist()))
            return out

        return work

    return map_rows(again, [text, "met", key], f"`{key}` {dict(files.dtypes)[key]}, runs array<bigint>", make).dropDuplicates([key])


def shared_rules(measured: DataFrame, repo: str = "repo_id", runs: DataFrame | None = None, key: str = "document_id") -> DataFrame:
    """rule, n_repos, n_files of the rules that occur in two repositories or more.

    runs: shared_runs(); a run of SHARED_TOKENS tokens counts as a rule, also where it stands
    once per file, so a longer shared passage shows as all runs in it. Counted in two steps: first per rule and repository, so a rule that is everywhere
    meets the final step once per repository only.
    """
    found = F.array_union(F.array("file_rule"), "long_rules")
    if runs is not None:
        measured = measured.select(key, repo, "file_rule", "long_rules").join(runs, key, "left")
        found = F.array_union(found, F.coalesce("runs", F.array().cast("array<bigint>")))
    rules = measured.where("file_rule is not null").select(repo, F.explode(found).alias("rule"))
    per_repo = rules.groupBy("rule", repo).agg(F.count("*").alias("n"))
    return per_repo.groupBy("rule").agg(F.count(repo).alias("n_repos"), F.sum("n").alias("n_files")).where("n_repos >= 2")
