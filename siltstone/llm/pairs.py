"""Defects of question-answer and task-solution records.

A record is cut at its section labels. Copies show when the answer, compressed
with the prompt as a Zstandard dictionary, needs next to nothing of its own.
Refusals and languages come from dictionaries. Whether an answer stops short is
judged by a terminal-context model: how often the tokens an answer ends with are
an end, counted over all answers.
"""

from __future__ import annotations

import re
from collections import Counter

import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_rows

#: Section labels (fixed values).
PROMPT_LABELS = "question|development task|task|instruction|prompt|frage|aufgabe|pregunta|tarea|tâche"
CODE_LABELS = "code|source|source code|quelle|quelltext|código|fuente"
ANSWER_LABELS = "answer|solution|response|antwort|lösung|respuesta|solución|réponse"
_LABEL = re.compile(rf"(?mi)^[ \t]*(?:#{{1,6}}[ \t]*|\*\*|__)?(?:({PROMPT_LABELS})|({CODE_LABELS})|({ANSWER_LABELS}))(?:(?:\*\*|__)?:(?:\*\*|__)?[ \t]*|(?:\*\*|__)[ \t]*$|[ \t]*$)")

#: Answers that say nothing (fixed values).
PLACEHOLDERS = {"na", "n a", "none", "null", "nil", "tbd", "todo", "tba", "no answer", "no solution", "empty", "unknown", "pending", "not available", "keine antwort", "keine", "ninguna", "sin respuesta", "aucune", "pas de réponse", "fixme", "placeholder", "insert answer here"}

#: Words that are frequent in one language and not in the others (fixed values).
FUNCTION_WORDS = {
    "en": "the is are which what when how why does do of to and with it its that this these each so in on for by from not has have would should can if than then where while there you we be was were or an at into only over",
    "de": "der die das den dem des ein eine einen einem einer und ist sind nicht mit von zu zum zur auf für wird werden wie warum welche welcher welches wenn dass sich auch aus bei nur über kann soll hängt also keinen keine kein es ab was gibt gib ändere ergänze behebe erkläre durch bis weil ihn dann",
    "es": "el la los las un una unos unas y es son no con de del que por para se en su sus como cómo qué cuál cuáles cuando si al lo más este esta estos depende así cada solo pero sin hay modo desde sobre entre cambia añade corrige explica vale devuelve",
    "fr": "avec le la les un une des du de et est sont ne pas avec que qui par pour se en sur dans son ses ce cette ces quand comment pourquoi quelles quelle quel quels si au aux plus dépend donc chaque il elle y suit vers afin où sans modifie ajoute corrige explique renvoie vaut lorsque l d n qu s",
}
_LANGUAGE_OF: dict[str, list[str]] = {}
for _lang, _list in FUNCTION_WORDS.items():
    for _w in _list.split():
        _LANGUAGE_OF.setdefault(_w, []).append(_lang)

#: Ways to decline, at the beginning of a sentence (fixed values).
REFUSALS = [
    r"(?:i'?m|i am) (?:very |really |so )?sorry\b.*\b(?:can'?t|cannot|unable|not able|won'?t)\b",
    r"(?:sorry|apologies|my apologies|unfortunately)\b.*\b(?:can'?t|cannot|unable|not able|won'?t|decline|guidelines|comfortable|refuse|against)\b",
    r"i (?:can'?t|cannot|can not|won'?t|will not|am unable to|am not able to|must decline|have to decline|refuse to|decline to|would rather not|do not feel comfortable|don'?t feel comfortable)(?: to)?(?: be able)?(?: to)?(?: not)? ?(?:assist|help|answer|provide|comply|respond|discuss|judge|do that|explain|share|support|write|fulfil|continue|this|that|from|$)",
    r"as an? (?:ai|language model|assistant|ai language model)\b.*\b(?:can'?t|cannot|not able|unable|won'?t|must not)\b",
    r"it (?:would|is) not (?:be )?appropriate for me to\b",
    r"(?:this|that|it) is (?:something|a request|a question) (?:that )?i (?:have to|must) (?:decline|refuse)\b",
    r"(?:answering|responding|this)\b.* (?:would go|goes) against my (?:guidelines|policy|policies|principles)\b",
    r"(?:no me es posible|no puedo|no podré|me resulta imposible|lamento no poder)\b.*\b(?:responder|ayudar|contestar|ofrecer|explicar|resolver|petición|pregunta|asistir)",
    r"lo siento\b.*\bno (?:puedo|podré|me es posible)\b",
    r"(?:debo|tengo que) (?:rechazar|declinar)\b",
    r"(?:je suis désolé|désolé|je regrette|malheureusement)\b.*\b(?:ne peux|ne puis|refuser|impossible)\b",
    r"je (?:ne (?:peux|puis|suis) pas|dois)\b.*\b(?:aider|répondre|refuser|décliner|fournir|expliquer|mesure)\b",
    r"(?:es tut mir leid|leider|entschuldigung|bedaure)\b.*\b(?:nicht|ablehnen|kein|keine)\b",
    r"(?:diese|dieser|diesen) (?:anfrage|frage|bitte|auftrag)\b.*\bablehnen\b",
    r"ich (?:kann|darf|werde|möchte) (?:(?:diese|dabei|ihnen|hier|das|darauf|dir) )*(?:\w+ )?(?:nicht|keine?)\b.*\b(?:helfen|antworten|beantworten|antwort|unterstützen|bereitstellen)\b",
]
_REFUSAL = re.compile("|".join(f"(?:{p})" for p in REFUSALS), re.IGNORECASE)
_QUOTED = re.compile(r"\"[^\"\n]*\"|“[^”\n]*”|«[^»\n]*»|„[^“\n]*“|`[^`\n]*`")
_FENCE = re.compile(r"```[^\n`]*\n?(.*?)(```|\Z)", re.DOTALL)
_LEAD = re.compile(r"^\W*(?:here(?:'s| is) (?:the |my |your )?(?:answer|solution|response)|sure|of course|certainly|answer|solution)\W+", re.IGNORECASE)
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")
_WORDS = re.compile(r"[^\W_]+")

#: Compressed size, over the size without the dictionary, below which an answer may be a copy; share of its words in runs of the prompt.
COPY_RATIO, COPY_SHARE = 0.75, 0.85
#: From this share of ends on, the last tokens of an answer are an end; so many ends, and this share of the tokens before them lead there.
END_SHARE, END_COUNT, LEAD_SHARE = 0.3, 3, 0.02


def sections(text: str | None) -> tuple[str, str, str | None]:
    """Prompt, code and answer of a record; None where no answer label follows the prompt."""
    marks = list(_LABEL.finditer(text or ""))
    prompt, code, answer = "", "", None
    first = next((i for i, m in enumerate(marks) if m.group(1)), None)
    if first is None:
        last = next((m for m in marks if m.group(3)), None)
        return "", "", (text[last.end() :].strip() if last else None)
    at_answer = next((i for i in range(first + 1, len(marks)) if marks[i].group(3)), None)
    for i in range(first, len(marks) if at_answer is None else at_answer):
        end = marks[i + 1].start() if i + 1 < len(marks) else len(text)
        part = text[marks[i].end() : end].strip()
        if marks[i].group(1) and not prompt:
            prompt = part
        elif marks[i].group(2):
            code += part
    if at_answer is not None:
        answer = text[marks[at_answer].end() :].strip()
    return prompt, code, answer


def prose_of(text: str) -> str:
    """A text without fenced blocks and without lines that look like code."""
    out = []
    for line in _FENCE.sub("\n", text).split("\n"):
        bare = _QUOTED.sub(" ", line).strip()
        if not bare or line.startswith(("    ", "\t", "  ")) or re.search(r"[;{}]\s*$|^\s*(?:def |class |func |fn |function |return\b|end$|else\b|#|//|\"\"\"|@)|[=<>]=|\w\(\w*\)\s*[:{]?$", bare):
            continue
        out.append(line)
    return "\n".join(out)


def language_of(text: str) -> str | None:
    """The language most function words of a text belong to; None without a clear lead."""
    score: Counter[str] = Counter()
    for w in _WORDS.findall(_QUOTED.sub(" ", text).lower()):
        for lang in _LANGUAGE_OF.get(w, ()):
            score[lang] += 1
    ranked = score.most_common(2)
    if not ranked or ranked[0][1] < 2:
        return None
    if len(ranked) > 1 and ranked[0][1] < ranked[1][1] + 2 and ranked[0][1] < 2 * ranked[1][1]:
        return None
    return ranked[0][0]


def _shape(text: str) -> str:
    return " ".join(_WORDS.findall(text.lower()))


def is_copy(answer: str, prompt: str) -> bool:
    """The answer says only what the prompt says, whatever its case and punctuation."""
    mine, theirs = _shape(_LEAD.sub("", answer)), _shape(prompt)
    if not mine or not theirs:
        return False
    data = mine.encode("utf-8", "surrogatepass")
    known = zstandard.ZstdCompressionDict(theirs.encode("utf-8", "surrogatepass"), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    options = {"level": 3, "write_content_size": False, "write_checksum": False}
    with_prompt = len(zstandard.ZstdCompressor(dict_data=known, **options).compress(data))
    alone = len(zstandard.ZstdCompressor(**options).compress(data))
    if with_prompt > COPY_RATIO * alone and mine != theirs:
        return False
    words, source = mine.split(), theirs.split()
    n = min(3, len(words), len(source))
    runs = {tuple(source[i : i + n]) for i in range(len(source) - n + 1)}
    covered = [False] * len(words)
    for i in range(len(words) - n + 1):
        if tuple(words[i : i + n]) in runs:
            covered[i : i + n] = [True] * n
    return sum(covered) >= COPY_SHARE * len(words)


def is_refusal(answer: str) -> bool:
    """A sentence of the answer, quotations aside, begins like a refusal."""
    bare = prose_of(answer)
    return any(_REFUSAL.match(s.strip(" -*>\t")) for s in _SENTENCE.split(_QUOTED.sub(" x ", bare)))


def is_empty(answer: str | None) -> bool:
    if not answer:
        return True
    shape = _shape(re.sub(r"```[^\n`]*", " ", answer))
    return not shape or shape in PLACEHOLDERS


_END_TOKEN = re.compile(r"`[^`\n]*`|[^\W\d_]+(?:_\w+)*\w*|\d[\w.]*|\n|[^\w\s]")
_NAME = re.compile(r"[a-zA-Z]+(?:_[\w]+|[a-z][A-Z]\w*)")
ORDER = 3


def end_tokens(text: str) -> list[str]:
    """Tokens with quoted names, names of several parts and numbers made alike."""
    out = []
    for t in _END_TOKEN.findall(text):
        if t[0] == "`" or _NAME.fullmatch(t):
            t = "`x`" if t[0] == "`" else "x"
        elif t[0].isdigit():
            t = "9"
        elif t == "\n" and out and out[-1] == "\n":
            continue
        out.append(t)
    while out and out[-1] == "\n":
        out.pop()
    return out


def end_key(tokens: list[str], at: int, order: int) -> int:
    part = tokens[max(0, at - order) : at]
    return xxhash.xxh3_64_intdigest("\x1f".join(part).encode("utf-8", "surrogatepass"), order) - (1 << 63)


def pieces(answer: str) -> list[tuple[str, bool]]:
    """Texts an answer consists of, each with whether it was closed: by its fence, or by what follows."""
    out, at = [], 0
    for m in _FENCE.finditer(answer):
        if answer[at : m.start()].strip():
            out.append((answer[at : m.start()], True))
        out.append((m.group(1), bool(m.group(2))))
        at = m.end()
    if answer[at:].strip():
        out.append((answer[at:], False))
    return out


def surely_ended(answer: str) -> bool | None:
    """True: it ends with a sentence or a closed block; False: inside a block; None: by its context."""
    last = pieces(answer)
    if not last:
        return None
    text, closed = last[-1]
    if closed:
        return True
    if answer.count("```") % 2:
        return False
    bare = text.rstrip(" \t\n*_)\"'”»")
    if bare and bare[-1] in ".!?。！？" and not bare.endswith("..."):
        return True
    return None


_OPEN, _CLOSE = "([{", ")]}"


def breaks_off(answer: str, record: str) -> bool:
    """Open brackets, or a last word that is only the beginning of a name used before."""
    last = pieces(answer)[-1][0] if answer else ""
    bare = re.sub(r"\"[^\"\n]*\"|'[^'\n]*'", "", last)
    if any(bare.count(a) > bare.count(b) for a, b in zip(_OPEN, _CLOSE, strict=True)):
        return True
    if last.count("`") % 2:
        return True
    m = re.search(r"(\w+)$", last.rstrip())
    if not m:
        return False
    word = m.group(1)
    before = record[: len(record.rstrip()) - len(word)]
    return not re.search(rf"(?<!\w){re.escape(word)}(?!\w)", before) and bool(re.search(rf"(?<!\w){re.escape(word)}\w", before))


PARTS = "defect string, end_key bigint, lead_key bigint"


def _seen_defect(record: str | None, prompt: str, answer: str | None) -> tuple[str | None, int | None, int | None]:
    if is_empty(answer):
        return "empty", None, None
    if is_refusal(answer):
        return "refusal", None, None
    if is_copy(answer, prompt):
        return "copied", None, None
    asked, told = language_of(prompt), language_of(prose_of(answer))
    if asked and told and asked != told:
        return "language", None, None
    ended = surely_ended(answer)
    if ended is True:
        return None, None, None
    if ended is False or breaks_off(answer, record):
        return "truncated", None, None
    tokens = end_tokens(pieces(answer)[-1][0])
    if not tokens:
        return None, None, None
    return None, end_key(tokens, len(tokens), ORDER), end_key(tokens, len(tokens) - 1, ORDER - 1)


def _count_ends(answer: str | None, seen: Counter[int], ends: Counter[int]) -> None:
    if is_empty(answer):
        return
    for piece, _ in pieces(answer):
        tokens = end_tokens(piece)
        n = len(tokens)
        for at in range(1, n + 1):
            seen[end_key(tokens, at, ORDER)] += 1
            seen[end_key(tokens, at, ORDER - 1)] += 1
        if n:
            ends[end_key(tokens, n, ORDER)] += 1


def survey(records: DataFrame, keep: list[str], text: str = "content") -> DataFrame:
    """What inspect() and end_counts() need, from one pass over the records.

    Rows with counts false are those of inspect(); rows with counts true have key, n and
    ends of one batch, and nulls in the columns of keep.
    """
    types = dict(records.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [PARTS, "counts boolean, key bigint, n bigint, ends bigint"])
    none = (None,) * (len(keep) + 3)

    def make():
        def work(texts, *kept):
            seen: Counter[int] = Counter()
            ends: Counter[int] = Counter()
            rows = []
            for t, *k in zip(texts, *kept, strict=True):
                prompt, _, answer = sections(t)
                rows.append((*k, *_seen_defect(t, prompt, answer), False, None, None, None))
                _count_ends(answer, seen, ends)
            return rows + [(*none, True, key, n, ends[key]) for key, n in seen.items()]

        return work

    return map_rows(records, [text, *keep], schema, make)


def inspect(surveyed: DataFrame) -> DataFrame:
    """The kept columns, the defect seen in the record alone, and the keys of its last tokens.

    defect: 'empty', 'refusal', 'copied', 'language' or 'truncated'; null where none is seen.
    end_key is null unless only the terminal-context model can tell whether the answer ends.
    A null record has no answer: 'empty'. Rows that agree in all of that are one.
    """
    return surveyed.where("not counts").drop("counts", "key", "n", "ends").distinct()


def end_counts(surveyed: DataFrame) -> DataFrame:
    """key, n, ends: how often each run of tokens occurs in answers, and how often it ends a piece of one.

    Counted over all records: in each batch first, then by key.
    """
    return surveyed.where("counts").groupBy("key").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))


def defects(inspected: DataFrame, counts: DataFrame) -> DataFrame:
    """inspected with its final defect: an answer whose last tokens are no usual end is 'truncated'."""
    ends = counts.select(F.col("key").alias("end_key"), F.col("n").alias("end_n"), F.col("ends").alias("end_ends"))
    leads = counts.select(F.col("key").alias("lead_key"), F.col("n").alias("lead_n"))
    joined = inspected.join(ends, "end_key", "left").join(leads, "lead_key", "left")
    usual = (F.col("end_ends") >= END_COUNT) & (F.col("end_ends") >= END_SHARE * F.col("end_n")) & (F.col("end_n") >= LEAD_SHARE * F.col("lead_n"))
    late = F.when(F.col("end_key").isNotNull() & ~F.coalesce(usual, F.lit(False)), "truncated")
    return joined.withColumn("defect", F.coalesce("defect", late)).drop("end_key", "lead_key", "end_n", "end_ends", "lead_n")
