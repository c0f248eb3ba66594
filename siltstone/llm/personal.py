"""Personal data in free text, found by a semi-Markov conditional random field.

Candidate segments carry features of the whole span: its form, the words before
and after it, the words in it. A text's labelling is a set of segments that do not
overlap, everything else being plain text; its weight is the sum of the weights of
its segments and of its transitions: a segment that follows another one closely
has a weight for both kinds and for what stands between them. A dynamic program
over the ends of the candidates finds the best labelling, deciding boundaries and
kinds together; the same lattice gives the expected features by which the weights
are fitted to the weakly labelled segments of a bounded sample. Segments without a
label take any part in it that agrees with the labels.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltstone.llm.arrow import map_rows

KINDS = ("email", "phone", "id_number", "address", "name")
#: Texts the weights are fitted on at most, passes over them, and the characters up to which segments are neighbours.
TRAINING_TEXTS, PASSES, NEAR = 2_500, 6, 24

_U = "A-ZÀ-ÖØ-Þ"
_L = "a-zß-öø-ÿ"

# Forms of segments

_EMAIL = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![A-Za-z0-9]|[\w-]*@|:[\w~/])")
_DOMAIN = r"[a-z0-9](?:[a-z0-9-]*[a-z0-9])?"
_DOT = r"\s?(?:\[\s?(?:dot|punkt|punto|point|\.)\s?\]|\(\s?(?:dot|punkt|punto|point|\.)\s?\)|\{\s?dot\s?\}|<dot>|\b(?:dot|punkt|punto|point)\b)\s?"
_HIDDEN = re.compile(
    rf"(?i)(?<![\w.@+-])[a-z0-9][a-z0-9._%+-]*(?:\s?(?:\[\s?(?:at|@)\s?\]|\(\s?(?:at|@)\s?\)|\{{\s?at\s?\}}|<at>)\s?{_DOMAIN}(?:(?:{_DOT}|\.){_DOMAIN})+"
    rf"|\s(?:at|arroba|chez)\s{_DOMAIN}(?:{_DOT}{_DOMAIN})+|@{_DOMAIN}(?:\.{_DOMAIN})*{_DOT}{_DOMAIN}(?:{_DOT}{_DOMAIN})*)(?![\w@])"
)
#: What every written-out address holds: a sign in brackets, or a dot as a word.
_HIDDEN_ANCHOR = re.compile(r"[\[({<]\s?(?:at|@|dot|punkt|punto|point|\.)|\b(?:dot|punkt|punto|point)\b")
_NUMBER = re.compile(r"(?<![\w.@/:+-])(?:\+\s?)?(?:\(0?\d{2,4}\)|\d)(?:[ ]?[-./]?[ ]?\(?\d\)?){6,17}(?:(?:,? ?(?:ext|x|Durchwahl|poste)\.? ?)\d{1,5})?(?![\w@]|[.:/-]\d)")
_DATE = re.compile(r"\d{4}-\d\d-\d\d|^\d{1,2}[./]\d{1,2}[./]\d{4}\b|^(?:\d{1,3}\.){3}\d{1,3}$|^\d+\.\d+\.\d+ ?\(")
_ID_VALUE = r"(?:[A-Z]{1,3}[ -]?)?\d(?:[ ./-]?[A-Z0-9]){4,22}(?![a-z0-9])|[A-Z0-9]{2,4}\d[A-Z0-9]{4,12}(?![a-z])"
#: Words before the number of a person (fixed values).
ID_CUES = r"SSN|social security(?: number| no\.?)?|passports?(?: number| no\.?)?|passeport|pasaporte|Reisepass(?:nummer)?|(?:Personal)?[Aa]usweis(?:nummer|nr\.?)?|Steuer-?(?:ID|nummer|Identifikationsnummer)|tax(?:payer)? ?(?:id|ID|number|no\.?)|TIN|national (?:ID|id|identity)(?: number| card)?|identity (?:number|card)|NIE|DNI|NIF|CIF|NINO?|(?:national )?insurance (?:no\.?|number)|[Ss]ozialversicherungs(?:nummer|nr\.?)|[Vv]ersichertennummer|driver'?s? licen[cs]e(?: number| no\.?)?|driving licen[cs]e|[Ff]ührerschein(?:nummer)?|permis de conduire|permiso de conducir|num[eé]ro (?:de sécurité sociale|fiscal|de passeport)|n[uú]mero (?:de la )?(?:seguridad social|fiscal)|carte d'identité"
_ID_CUED = re.compile(rf"(?:\b(?:{ID_CUES}))(?:\s?[:#=]|\s(?:is|ist|es|est|no\.?|nr\.?|number|lautet))?\s?({_ID_VALUE})")
#: What the cues of identity numbers and of persons hold, in lower case, or in capitals where only those count (fixed values).
_ID_FIRST = ("ssn", "social security", "passport", "passeport", "pasaporte", "reisepass", "ausweis", "steuer", "tax", "TIN", "national i", "identity", "NIE", "DNI", "NIF", "CIF", "NIN", "insurance n", "versicherungsn", "versicherten", "licence", "license", "führerschein", "permis", "numero", "número", "numéro", "carte d")
_PERSON_WORDS = ("thanks to ", "and to ", "cc ", "@author ", "-by: ", "reported by ", "contact: ", "spoke with ", "danke an ", "gracias a ", "merci à ", "von ", "informó ", "par ", "partner: ", "row: ", "goes to ", "geräte an ", "va a ", "chez ")
#: Words of street names: they end, begin or contain the name (fixed values).
STREET_EN = "Street|St|Avenue|Ave|Road|Rd|Lane|Ln|Court|Ct|Terrace|Drive|Dr|Hill|Row|Way|Place|Pl|Square|Close|Crescent|Gardens|Boulevard|Blvd|Grove|Walk|Mews|Parade|Green"
STREET_DE = "straße|strasse|str\\.|weg|platz|allee|gasse|ring|damm|ufer|stieg|steig|chaussee|markt|graben|pfad"
STREET_FR = "rue|avenue|impasse|chemin|boulevard|allée|place|quai|cours|route|passage|sentier|square"
STREET_ES = "Calle|Avenida|Avda\\.|Rúa|Paseo|Plaza|Camino|Ronda|Carretera|Travesía|Callejón|Cuesta|Carrer|C/"
_TITLE = rf"[{_U}][{_L}'’]+"
_CITY = rf"[{_U}][{_L}'’]+(?:[ -](?:am |an der |im |sur |de |del |la |las |los |le |les |en |upon |on )*[{_U}][{_L}'’]+){{0,2}}(?:(?: am| an der| im| sur) [{_U}][{_L}]+)?"
_FLAT = r"(?:Flat|Apt\.?|Apartment|Unit|Suite|Room|No\.)\s?\d+\w?"
_ADDRESS = re.compile(
    rf"(?<![\w-])(?:(?:{_FLAT},? )?\d{{1,4}} ?[a-zA-Z]?(?<! ) (?:{_TITLE} ){{1,4}}(?:{STREET_EN})\b\.?(?:,? {_FLAT})?(?:, {_CITY})?(?: \d{{4,5}}(?!\d))?"
    rf"|{_FLAT}, \d{{1,4}}\w? (?:{_TITLE} ){{1,4}}(?:{STREET_EN})\b"
    rf"|(?:[{_U}][{_L}]+(?:{STREET_DE})|[{_U}][{_L}]+(?:er |-)(?:{STREET_DE.title()}|Straße)|(?:Am|An der|Im|Zum|Zur) {_TITLE}) \d{{1,4}} ?[a-z]?(?![\w])(?:, (?:D-)?\d{{5}} {_CITY})?"
    rf"|\d{{1,4}}(?: bis| ter)?,? (?:{STREET_FR}) (?:[\w'’À-ÿ-]+ ?){{1,5}}?(?=,|\.|$|\n)(?:, \d{{5}} {_CITY})?"
    rf"|(?:{STREET_ES}) (?:(?:de |del |de la |de los |do |da |la |el )*{_TITLE} ?){{1,4}}, (?:n\.?º ?)?\d{{1,4}}(?:, (?:\d{{1,2}}\.?º(?: ?[A-Z])?|bajo|ático|bajos|entresuelo)(?: ?[A-Z](?![\w]))?)?(?:, \d{{5}} {_CITY})?)",
    re.MULTILINE,
)
_PART = rf"[{_U}][{_L}'’]+(?:-[{_U}][{_L}'’]+)?"
_CAPITAL = rf"[{_U}]{{3,}}(?:-[{_U}]{{3,}})?"
_NAME = re.compile(rf"(?<![\w@.-])(?:{_PART} (?:[{_U}]\.? )?{_PART}|{_CAPITAL}, {_PART}(?: [{_U}]\.)?|{_PART}, {_PART}|{_CAPITAL} {_CAPITAL}|{_PART} {_CAPITAL})(?![\w@]|-\w)")
_TITLES = {"Dr", "Mr", "Ms", "Mrs", "Prof", "Herr", "Frau", "Sr", "Sra", "Mme", "Mlle", "Miss", "Don", "Doña", "Señor", "Señora", "Monsieur", "Madame"}
#: Words before a person, also written small (fixed values).
_PERSON_CUE = re.compile(r"(?i)(?:\bthanks to|\band to|\bcc:?|@author|\b(?:signed|reviewed|acked|tested|reported|co-authored)(?:-off)?-by:|\breported by|\bcontact:|\bspoke with|\bdanke an|\bgracias a|\bmerci à|\bgemeldet von|\binformó|\bsignalé par|\bansprechpartner(?:in)?:|\bcontacto:|\brow:|\bgoes to|\bgeräte an|\benvío va a|\bchez|\bwritten by|\basked by)\s+(?:(?:dr|mr|ms|mrs|prof|herr|frau|sra?|mme)\.?\s+)?$")
_PERSON_AFTER = re.compile(r",? (?:wrote|writes|schrieb|escribió|a écrit) ")
_SMALL = re.compile(rf"(?:(?:[Tt]hanks to|and to|cc|@author|-by:|[Rr]eported by|[Cc]ontact:|spoke with|[Dd]anke an|[Gg]racias a|[Mm]erci à|von|[Ii]nformó|par|partner:|row:|goes to|Geräte an|va a|chez) (?:(?:[Dd]r|[Mm]r|[Mm]s|[Mm]rs|[Pp]rof)\.? )?([{_L}]{{2,}} (?:[{_L}]\. )?[{_L}]{{3,}}(?:-[{_L}]{{3,}})?)(?=\s+(?:for the|für die|por la|pour la|about|<|/|wrote on|[{_U}`]|-)|,|\s*\n|\s*$)|(?:(?<=[.!?] )|^)([{_L}]{{3,}} [{_L}]{{3,}}(?:-[{_L}]{{3,}})?)(?= wrote on ))", re.MULTILINE)
_BEFORE = re.compile(r"[\w@#'’-]+[:=]?|[^\w\s]")
_AFTER = re.compile(r"[\w'’@-]+|[^\w\s]")
#: Words that begin no name (fixed values).
NO_NAME = set(
    "the this these that a an in on at if it we i you they he she our your its set pin see each after on order build ticket version reviewers please nothing throughput clone here there when while what which who how why then also but and or not no yes as by for from with without to of "
    "der die das den dem des ein eine einen im am ab auf bei bitte wir vorgang lauf es er sie und oder nicht mit von zu zum zur für aus in nach vor über unter wenn wie was "
    "el la los las un una en de del desde por para con sin como qué cómo cuando se su no y o al lo cambia adelantamos escribid "
    "thanks call hardware contact mail send reported signed someone danke gracias merci informó signalé gemeldet rückfragen ansprechpartner alguien quelqu "
    "le les un une des du au aux en dans sur avec pour par depuis nous il elle on et ou ne pas que qui écrivez mettez l".split()
)


def _around(pattern: re.Pattern, text: str, low: str, words: tuple[str, ...] | re.Pattern, left: int, right: int) -> list[re.Match]:
    """Matches of a pattern that has one of the words in it, looked for around the words only.

    words: in low, or in text where they have capitals; or a pattern for low.
    """
    if len(low) != len(text):
        return list(pattern.finditer(text))
    found: dict[int, re.Match] = {}

    def look(at: int) -> None:
        low_end, high_end = max(0, at - left), min(len(text), at + right)
        while low_end > 0 and not text[low_end - 1].isspace():
            low_end -= 1  # no word is cut in two
        while True:
            while high_end < len(text) and not text[high_end].isspace():
                high_end += 1
            matches = list(pattern.finditer(text, low_end, high_end))
            if not matches or matches[-1].end() < high_end - 1 or high_end == len(text):
                break
            high_end = min(len(text), high_end + right)  # it may go on behind the window
        for m in matches:
            known = found.get(m.start())
            if known is None or known.end() < m.end():
                found[m.start()] = m

    if isinstance(words, re.Pattern):
        for anchor in words.finditer(low):
            look(anchor.start())
    else:
        for word in words:
            source = low if word == word.lower() else text
            at = source.find(word)
            while at >= 0:
                look(at)
                at = source.find(word, at + len(word))
    out: list[re.Match] = []
    for m in sorted(found.values(), key=lambda m: (m.start(), -m.end())):
        if not out or m.start() >= out[-1].end():
            out.append(m)
    return out


@dataclass
class Segment:
    start: int
    end: int
    kind: str
    form: str
    names: list[str] = field(default_factory=list)
    weak: int | None = None
    score: float = 0.0


def _near(text: str, start: int, end: int) -> tuple[list[str], list[str]]:
    before = [w.lower() for w in _BEFORE.findall(text[max(0, start - 48) : start])][-3:]
    after = [w.lower() for w in _AFTER.findall(text[end : end + 24])][:2]
    return before, after


def _digits(s: str) -> str:
    return "".join(c for c in s if c.isdigit())


def _phone_form(s: str) -> str | None:
    bare = re.split(r",? ?(?:ext|x|Durchwahl|poste)", s)[0]
    n = len(_digits(bare))
    if not 7 <= n <= 15 or _DATE.search(bare):
        return None
    if bare.startswith("+"):
        return "international" if n >= 9 else None
    if bare.startswith("00"):
        return "international" if n >= 10 else None
    if bare.startswith("("):
        return "bracket"
    if re.fullmatch(r"\d{3}([-. ])\d{3}\1\d{4}", bare):
        return "grouped"
    if bare.startswith("0") and n >= 9:
        return "trunk"
    if re.fullmatch(r"[679]\d{2}(?:[ .-]?\d{2,3}){2,4}", bare) and n == 9:
        return "nine"
    return "loose"


_PHONE_CUE = re.compile(r"(?i)\b(?:call|phone|tel\w*|mobile|fax|pager|teléfono|móvil|llam\w+|appel\w+|ruf\w*|handy|oder|or|ou|au)\W*$|[/;]\s*$|\b(?:contact|contacto|kontakt|ansprechpartner(?:in)?)\b[^\n]{0,50}[,/]\s*$")
_COUNT_CUE = re.compile(r"(?i)\b(?:order|ticket|build|version|lauf|vorgang|incidencia|tâche|tarea|row|line|port|id|id:|batch|number|from|to|issue|commit|pedido|commande|bestellung|invoice|serial|isbn|sample|error|code|rebase on|commit)\W*$")


def segments(text: str) -> list[Segment]:
    """All candidate segments of a text with their features, in order of their start."""
    out: list[Segment] = []

    def add(start: int, end: int, kind: str, form: str, weak: int | None, *more: str) -> None:
        before, after = _near(text, start, end)
        names = [f"{kind}", f"{kind}|{form}"]
        names += [f"{kind}<{i}{w}" for i, w in enumerate(reversed(before[-2:]))]
        names += [f"{kind}>{w}" for w in after[:1]]
        names += [f"{kind}~{m}" for m in more]
        names.append(f"{kind}#{min(8, (end - start) // 6)}")
        out.append(Segment(start, end, kind, form, names, weak))

    low = text.lower()
    if "@" in text:
        for m in _EMAIL.finditer(text):
            local = m.group().split("@")[0].lower()
            repository = local in ("git", "hg", "svn")
            add(m.start(), m.end(), "email", "plain", 0 if repository else 1, "repository" if repository else "local")
    for m in _around(_HIDDEN, text, low, _HIDDEN_ANCHOR, 130, 130):
        cue = re.search(r"(?i)(?:mail|reach them at|to|for|an|a|à|unter|bounced for|correo|write|<|=>|;|contact:?)\s*$", text[max(0, m.start() - 20) : m.start()])
        head = re.match(r"(?i)[a-z0-9._%+-]+", m.group()).group()
        add(m.start(), m.end(), "email", "spelled", 1 if cue else None, "local" if re.search(r"[\d._+-]", head) else "word")
    for m in _NUMBER.finditer(text):
        form = _phone_form(m.group())
        if not form:
            continue
        left = text[max(0, m.start() - 64) : m.start()]
        if form == "loose" and not _PHONE_CUE.search(left):
            continue
        weak = 0 if _COUNT_CUE.search(left) else 1 if _PHONE_CUE.search(left) else None
        add(m.start(), m.end(), "phone", form, weak, f"n{len(_digits(m.group()))}", "cue" if weak == 1 else "count" if _COUNT_CUE.search(left) else "none")
    for m in _around(_ID_CUED, text, low, _ID_FIRST, 30, 100):
        value = m.group(1).rstrip(" .-/")
        if len(_digits(value)) < 5:
            continue
        add(m.start(1), m.start(1) + len(value), "id_number", "cued", 1, "cue")
    for m in _ADDRESS.finditer(text):
        value = m.group().rstrip(" ,.")
        whole = bool(re.search(rf", (?:\d{{5}} )?{_CITY}(?: \d{{4,5}})?$", value))
        add(m.start(), m.start() + len(value), "address", "city" if whole else "street", 1 if whole else None)
    at = 0
    while m := _NAME.search(text, at):
        at = m.end()
        words = re.findall(rf"[{_U}{_L}'’]+", m.group())
        if words[0] in _TITLES or words[0].lower() in NO_NAME or text[m.start() - 1 : m.start()] == "`":
            at = m.start() + len(words[0])
            continue
        left = text[max(0, m.start() - 40) : m.start()]
        cue = bool(_PERSON_CUE.search(left))
        small = any(f" {w.lower()}{c}" in text for w in words if len(w) > 1 for c in (" ", ".", ","))
        cue = cue or bool(_PERSON_AFTER.match(text, m.end()))
        heading = bool(re.search(r"(?:^|\n)#+ ?$", left))
        comma = "," in m.group()
        if comma and not m.group().split(",")[0].isupper() and not cue:
            at = m.start() + len(words[0])
            continue
        form = "comma" if comma else "capital" if m.group().isupper() else "initial" if any(len(w) == 1 for w in words) else "pair"
        weak = 0 if heading or (small and not cue) else 1 if cue and not small else None
        line = not left.rsplit("\n", 1)[-1].strip() and text[m.end() : m.end() + 1] in ("", "\n", "\r")
        more = ["cue" if cue else "none", "small" if small else "large", "heading" if heading else "text", *[f"w{w.lower()}" for w in words if len(w) > 1], f"s{words[-1].lower()[-4:]}"]
        add(m.start(), m.end(), "name", form, weak, *more, *(["line"] if line else []))
        at = m.start() + len(words[0])  # the next word may begin a name too; which of them counts is the field's to decide
    for m in _around(_SMALL, text, low, (*_PERSON_WORDS, " wrote on "), 70, 90):
        which = 1 if m.group(1) else 2
        words = m.group(which).split()
        if words[0] in NO_NAME or words[-1] in NO_NAME:
            continue
        add(m.start(which), m.end(which), "name", "small", None, "cue", *[f"w{w}" for w in words if len(w) > 2], f"s{words[-1][-4:]}")
    out.sort(key=lambda s: (s.start, s.end))
    return out


def clusters(found: list[Segment]) -> list[list[Segment]]:
    """Groups of segments that overlap or are neighbours; the labelling of one does not bear on another."""
    out: list[list[Segment]] = []
    end = -NEAR - 1
    for s in found:
        if s.start <= end + NEAR:
            out[-1].append(s)
        else:
            out.append([s])
        end = max(end, s.end)
    return out


_SIGNS = re.compile(r"[^\w\s]|\n|\w")


def between(a: Segment, b: Segment, gap: str) -> str:
    """The transition feature of b following a: both kinds, and the first sign that parts them."""
    m = _SIGNS.search(gap)
    sign = "" if not m else "w" if m.group().isalnum() or m.group() == "_" else m.group()
    return f"{a.kind}>{b.kind}{sign}"


@dataclass
class Lattice:
    """Segments of a cluster in order of their end, and which may follow which.

    far: for each segment, how many of the others end so far before it that no transition
    has a weight (they come first); near: those that end before it but closer, each with its transition.
    """

    group: list[Segment]
    far: list[int]
    near: list[list[tuple[int, str]]]


def lattice(group: list[Segment], text: str) -> Lattice:
    group = sorted(group, key=lambda s: (s.end, s.start))
    far, near = [], []
    for s in group:
        k = 0
        while group[k].end < s.start - NEAR:
            k += 1
        far.append(k)
        close = []
        while group[k].end <= s.start and group[k] is not s:
            close.append((k, between(group[k], s, text[group[k].end : s.start])))
            k += 1
        near.append(close)
    return Lattice(group, far, near)


def best(lat: Lattice, weights: dict[str, float]) -> list[Segment]:
    """The labelling of a cluster with the largest weight, by dynamic programming."""
    group = lat.group
    if len(group) == 1:
        return group if group[0].score > 0 else []
    value: list[float] = []  # of the best labelling whose last segment is this one
    back: list[int] = []
    top, top_at = [0.0], [-1]  # best value over the first k segments, nothing being one choice
    for j, s in enumerate(group):
        most, from_ = top[lat.far[j]], top_at[lat.far[j]]
        for i, name in lat.near[j]:
            v = value[i] + weights.get(name, 0.0)
            if v > most:
                most, from_ = v, i
        value.append(most + s.score)
        back.append(from_)
        if value[j] > top[j]:
            top.append(value[j])
            top_at.append(j)
        else:
            top.append(top[j])
            top_at.append(top_at[j])
    out, at = [], top_at[-1]
    while at >= 0:
        out.append(group[at])
        at = back[at]
    return out[::-1]


_NEVER = -1e9


def _log_sum(values: list[float]) -> float:
    m = max(values)
    return m + math.log(sum(math.exp(v - m) for v in values)) if m > _NEVER else _NEVER


def expected(lat: Lattice, scores: list[float], weights: dict[str, float]) -> tuple[list[float], dict[str, float]]:
    """Chance of each segment, and expected number of each transition, over all labellings."""
    n = len(scores)
    ahead: list[float] = []  # logarithm of the summed weights of labellings that end with this segment
    sums = [0.0]  # of those whose last segment is among the first k, or that are empty
    for j in range(n):
        ways = [sums[lat.far[j]]] + [ahead[i] + weights.get(name, 0.0) for i, name in lat.near[j]]
        ahead.append(_log_sum(ways) + scores[j])
        sums.append(_log_sum([sums[j], ahead[j]]))
    total = sums[n]
    # chance by the derivative of the logarithm of the sum: of a segment as the last so far, and of each sum
    last, part = [0.0] * n, [0.0] * (n + 1)
    part[n] = 1.0
    chance = [0.0] * n
    moves: dict[str, float] = {}
    for j in range(n - 1, -1, -1):
        if part[j + 1]:
            share = math.exp(min(0.0, ahead[j] - sums[j + 1]))
            last[j] += part[j + 1] * share
            part[j] += part[j + 1] * (1.0 - share)
        chance[j] = last[j]
        if last[j] <= 0.0:
            continue
        whole = ahead[j] - scores[j]
        part[lat.far[j]] += last[j] * math.exp(min(0.0, sums[lat.far[j]] - whole))
        for i, name in lat.near[j]:
            p = last[j] * math.exp(min(0.0, ahead[i] + weights.get(name, 0.0) - whole))
            last[i] += p
            moves[name] = moves.get(name, 0.0) + p
    del total
    return chance, moves


def _score(group: list[Segment], weights: dict[str, float]) -> None:
    for s in group:
        s.score = sum(weights.get(f, 0.0) for f in s.names)


def _gold(group: list[Segment]) -> list[Segment]:
    """Of segments labelled 1 the longest ones that do not overlap."""
    gold: list[Segment] = []
    for s in sorted(group, key=lambda s: s.start - s.end):
        if s.weak == 1 and all(s.end <= o.start or s.start >= o.end for o in gold):
            gold.append(s)
    return gold


def fit(texts: list[str], passes: int = PASSES, rate: float = 0.3, decay: float = 1e-4) -> dict[str, float]:
    """Weights that make the weak labels of the texts likely.

    Segments labelled 1 are held to be in, those labelled 0 or crossing one labelled 1 to be
    out, the others are free: the weights move by the difference between what is expected
    under these ties and without them.
    """
    groups: list[tuple[Lattice, list[int | None]]] = []
    for t in texts:
        for g in clusters(segments(t)):
            lat = lattice(g, t)
            gold = _gold(lat.group)
            held = [1 if s in gold else 0 if s.weak is not None or any(s.start < o.end and o.start < s.end for o in gold) else None for s in lat.group]
            if any(y is not None for y in held):
                groups.append((lat, held))
    weights: dict[str, float] = {}
    power: dict[str, float] = {}

    def move(name: str, by: float) -> None:
        step = by - decay * weights.get(name, 0.0)
        power[name] = power.get(name, 1e-8) + step * step
        weights[name] = weights.get(name, 0.0) + rate * step / math.sqrt(power[name])

    for _ in range(passes):
        for lat, held in groups:
            _score(lat.group, weights)
            scores = [s.score for s in lat.group]
            if len(scores) == 1:
                own = [1 / (1 + math.exp(-max(-30.0, min(30.0, scores[0]))))], {}
                tied = [float(held[0])], {}
            else:
                own = expected(lat, scores, weights)
                tied = expected(lat, [x + 50.0 if y == 1 else _NEVER if y == 0 else x for x, y in zip(scores, held, strict=True)], weights)
            for s, p, y in zip(lat.group, own[0], tied[0], strict=True):
                if abs(y - p) >= 1e-3:
                    for f in s.names:
                        move(f, y - p)
            for name in own[1].keys() | tied[1].keys():
                by = tied[1].get(name, 0.0) - own[1].get(name, 0.0)
                if abs(by) >= 1e-3:
                    move(name, by)
    return {f: w for f, w in weights.items() if abs(w) > 1e-6}


def train(documents: DataFrame, text: str = "text", limit: int = TRAINING_TEXTS) -> dict[str, float]:
    """Weights fitted on limit texts at most, chosen by hash."""
    sample = documents.where(F.col(text).isNotNull()).select(text).orderBy(F.xxhash64(text), text).limit(limit)
    return fit([r[0] for r in sample.toLocalIterator()])


def spans(text: str | None, weights: dict[str, float]) -> list[Segment]:
    if not text:
        return []
    out = []
    for g in clusters(segments(text)):
        _score(g, weights)
        out += best(lattice(g, text) if len(g) > 1 else Lattice(g, [], []), weights)
    return sorted(out, key=lambda s: s.start)


def find(documents: DataFrame, keep: list[str], weights: dict[str, float], text: str = "text") -> DataFrame:
    """One row per occurrence: the columns of keep, kind, start_pos from 1 in code points, length and score."""
    types = dict(documents.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["kind string, start_pos int, length int, score double"])
    sent = documents.sparkSession.sparkContext.broadcast(weights)

    def make():
        own = sent.value

        def work(texts, *kept):
            return [(*k, s.kind, s.start + 1, s.end - s.start, s.score) for t, *k in zip(texts, *kept, strict=True) for s in spans(t, own)]

        return work

    return map_rows(documents, [text, *keep], schema, make)


def mask_text(text: str | None, weights: dict[str, float]) -> str | None:
    """The text with [EMAIL], [PHONE], [ID_NUMBER], [ADDRESS] and [NAME] in place of its segments."""
    if not text:
        return text
    out, last = [], 0
    for s in spans(text, weights):
        out += [text[last : s.start], f"[{s.kind.upper()}]"]
        last = s.end
    return "".join([*out, text[last:]])


def mask(documents: DataFrame, keep: list[str], weights: dict[str, float], text: str = "text") -> DataFrame:
    """The columns of keep with masked, the text with typed placeholders; null texts stay null."""
    types = dict(documents.dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + ["masked string"])
    sent = documents.sparkSession.sparkContext.broadcast(weights)

    def make():
        own = sent.value

        def work(texts, *kept):
            return [(*k, mask_text(t, own)) for t, *k in zip(texts, *kept, strict=True)]

        return work

    return map_rows(documents, [text, *keep], schema, make)
