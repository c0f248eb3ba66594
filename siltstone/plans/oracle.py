"""The core queries in SQL, written against the same tables."""

from __future__ import annotations

from siltstone.operators.generation import MOCK_TEXTS, MODEL_VERSIONS, PROMPTS
from siltstone.operators.quotas import BASE_BRANCHES
from siltstone.operators.rules import PROSE_RULES, RULES, Rule

WS = r"\s\x{1c}-\x{1f}\x{0b}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
TOKEN = rf"[\p{{L}}\p{{N}}_]+|[^\p{{L}}\p{{N}}_{WS}]"
LINE_END = r"\r\n|[\n\x0b\x0c\r\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
ORDER = "ingested_at, document_id, source_shard"


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def norm(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS}]+', ' ', 'g'))"


def count_of(x: str, pattern: str) -> str:
    return f"len(regexp_extract_all({x}, {quoted(pattern)}))"


def tokens_of(x: str) -> str:
    return f"regexp_extract_all({x}, {quoted(TOKEN)})"


def words_between_blanks(x: str) -> str:
    return f"coalesce({count_of(x, f'[^{WS}]+')}, 0)"


UNIQUE = f"""u AS (
    SELECT *, sha256(content) AS content_hash, row_number() OVER () AS rid FROM code_documents
    QUALIFY content IS NULL OR row_number() OVER (PARTITION BY sha256(content) ORDER BY {ORDER}) = 1)"""
CONTAMINATED = f"""e AS (SELECT DISTINCT {norm("content")} AS e FROM evaluation_documents WHERE {norm("content")} <> ''),
    un AS (SELECT document_id, {norm("content")} AS t FROM u WHERE content IS NOT NULL),
    dirty AS (SELECT DISTINCT document_id FROM un JOIN e ON t = e OR (length(e) >= 40 AND contains(t, e)))"""


def similar(source: str, threshold: float) -> str:
    """CTEs ending in pairs(a, b, similarity) over source(document_id, content)."""
    return f"""
    tk AS (SELECT document_id, {tokens_of("content")} AS t FROM {source} WHERE content IS NOT NULL),
    sh AS (SELECT document_id, CASE WHEN len(t) < 5 THEN [array_to_string(t, ' ')] ELSE
            list_distinct(list_transform(range(1, len(t) - 3), lambda i: array_to_string(list_slice(t, i, i + 4), ' '))) END AS s FROM tk),
    ex AS (SELECT document_id, len(s) AS n, unnest(s) AS g FROM sh),
    df AS (SELECT g, count(*) AS df FROM ex GROUP BY g),
    pf AS (SELECT document_id, n, g FROM (
            SELECT document_id, n, g, df, row_number() OVER (PARTITION BY document_id ORDER BY df, g) AS r FROM ex JOIN df USING (g))
           WHERE r <= n - ceil(n * {threshold} - 1e-9) + 1 AND df > 1),
    cand AS (SELECT DISTINCT a.document_id AS a, b.document_id AS b FROM pf a JOIN pf b USING (g) WHERE a.document_id < b.document_id),
    scored AS (SELECT a, b, len(list_intersect(x.s, y.s)) AS i, len(x.s) AS na, len(y.s) AS nb
            FROM cand JOIN sh x ON x.document_id = a JOIN sh y ON y.document_id = b),
    pairs AS (SELECT a, b, i / (na + nb - i)::DOUBLE AS similarity FROM scored WHERE i / (na + nb - i)::DOUBLE >= {threshold})"""


#: Greedy choice over the keys that have a neighbour, one after the other in their order.
GREEDY = """
    nodes AS (SELECT k, row_number() OVER (ORDER BY k) AS i FROM (SELECT a AS k FROM pairs UNION SELECT b FROM pairs)),
    near AS (SELECT i, k, coalesce((SELECT list(a) FROM pairs WHERE b = k), []) AS before FROM nodes),
    greedy(i, kept) AS (
        SELECT 0::BIGINT, []::VARCHAR[]
        UNION ALL
        SELECT near.i, CASE WHEN list_has_any(greedy.kept, near.before) THEN greedy.kept ELSE list_append(greedy.kept, near.k) END
        FROM greedy JOIN near ON near.i = greedy.i + 1),
    gone AS (SELECT k FROM nodes WHERE k NOT IN (SELECT unnest(kept) FROM (SELECT kept FROM greedy ORDER BY i DESC LIMIT 1)))"""


#: Languages whose lexemes are told, and what counts as a digit beside the decimal ones; written down here by themselves.
LANGUAGES = "c c# c++ dart go java javascript kotlin php python ruby rust scala swift typescript".split()
DIGITS = r"\p{Nd}\x{b2}\x{b3}\x{b9}\x{1369}-\x{1371}\x{19da}\x{2070}\x{2074}-\x{2079}\x{2080}-\x{2089}\x{2460}-\x{2468}\x{2474}-\x{247c}\x{2488}-\x{2490}\x{24ea}\x{24f5}-\x{24fd}\x{24ff}\x{2776}-\x{277e}\x{2780}-\x{2788}\x{278a}-\x{2792}\x{10a40}-\x{10a43}\x{10e60}-\x{10e68}\x{11052}-\x{1105a}\x{1f100}-\x{1f10a}"
#: Comments and strings: to the line's end, between marks, in quotes with escapes.
SLASHES, HASH, BETWEEN = r"//[^\n]*", r"#[^\n]*", r"/[*](?:[^*]|[*]+[^*/])*[*]+/"
IN_QUOTES, IN_TICKS, IN_MARKS = r'"(?:[^"\\\n]|\\.)*"', r"'(?:[^'\\\n]|\\.)*'", r"`[^`]*`"
LONG = r'"""(?:[^"]|"[^"]|""[^"])*"""' + "|" + r"'''(?:[^']|'[^']|''[^'])*'''"
LEXEME_PARTS = {
    "python": [LONG, HASH, IN_QUOTES, IN_TICKS],
    "ruby": [HASH, IN_QUOTES, IN_TICKS],
    "php": [SLASHES, HASH, BETWEEN, IN_QUOTES, IN_TICKS],
    "rust": [SLASHES, BETWEEN, IN_QUOTES],
    "javascript": [SLASHES, BETWEEN, IN_QUOTES, IN_TICKS, IN_MARKS],
    "typescript": [SLASHES, BETWEEN, IN_QUOTES, IN_TICKS, IN_MARKS],
    "go": [SLASHES, BETWEEN, IN_QUOTES, IN_TICKS, IN_MARKS],
}


def lexeme_lists(x: str, label: str) -> str:
    """Comments and strings in the order they are met; none for a language that is not known."""
    usual = [SLASHES, BETWEEN, IN_QUOTES, IN_TICKS]
    return "CASE " + " ".join(f"WHEN {label} = '{k}' THEN regexp_extract_all({x}, {quoted('|'.join(LEXEME_PARTS.get(k, usual)))})" for k in LANGUAGES) + " ELSE []::VARCHAR[] END"


def ratio(a: str, b: str) -> str:
    return f"({a})::DOUBLE / greatest({b}, 1)::DOUBLE"


def signals(source: str, key: str = "document_id") -> str:
    """CTEs ending in sig(key, the signals) over source(key, content, language)."""
    sized = lambda f: f"coalesce(list_sum(list_transform({f})), 0)"
    gram = lambda k: f"""CASE WHEN len(t) < {k} THEN 0.0 ELSE (SELECT max(c) FROM (SELECT count(*) AS c FROM (
        SELECT unnest(list_transform(range(1, len(t) - {k - 2}), lambda i: array_to_string(list_slice(t, i, i + {k - 1}), ' '))) AS g) GROUP BY g)) * {k} / len(t)::DOUBLE END"""  # noqa: E731
    return f"""
    raw AS (SELECT {key}, content AS c, lower(coalesce(language, '')) AS l, {tokens_of("content")} AS t,
            regexp_extract_all(content, '[\\p{{L}}\\p{{N}}_]+') AS w, string_split_regex(content, {quoted(LINE_END)}) AS p,
            {lexeme_lists("content", "lower(coalesce(language, ''))")} AS x FROM {source} WHERE content IS NOT NULL),
    lin AS (SELECT *, CASE WHEN p[-1] = '' THEN p[:-2] ELSE p END AS ln FROM raw),
    cut AS (SELECT *, list_filter(list_transform(ln, lambda q: regexp_replace(q, '^[{WS}]+|[{WS}]+$', '', 'g')), lambda q: q <> '') AS f FROM lin),
    sig AS (SELECT {key}, c, length(c) AS num_characters, strlen(c) AS num_bytes, len(w) AS num_words, len(ln) AS num_lines,
        {ratio(sized("w, lambda q: length(q)"), "len(w)")} AS mean_word_length,
        coalesce(list_max(list_transform(ln, lambda q: length(q))), 0) AS max_line_length,
        {ratio(sized("ln, lambda q: length(q)"), "len(ln)")} AS mean_line_length,
        {ratio("length(c) - length(replace(c, chr(65533), ''))", "length(c)")} AS replacement_character_fraction,
        {ratio("len(f) - len(list_distinct(f))", "len(f)")} AS duplicate_line_fraction,
        {gram(2)} AS top_2gram_fraction, {gram(3)} AS top_3gram_fraction, {gram(4)} AS top_4gram_fraction,
        {ratio(count_of("c", r"\p{L}"), "length(c)")} AS alphabetic_fraction,
        {ratio(count_of("c", f"[{DIGITS}]"), "length(c)")} AS numeric_fraction,
        {ratio(count_of("c", f"[{WS}]"), "length(c)")} AS whitespace_fraction,
        {ratio(sized("regexp_extract_all(c, '[A-Za-z0-9+/]{100,}={0,2}'), lambda q: length(q)"), "length(c)")} AS encoded_data_fraction,
        l IN ({", ".join(f"'{k}'" for k in LANGUAGES)}) AS parse_supported,
        {ratio(sized("list_filter(x, lambda q: regexp_matches(q, '^(//|/[*]|#)')), lambda q: strlen(q)"), "strlen(c)")} AS comment_fraction,
        {ratio(sized("list_filter(x, lambda q: NOT regexp_matches(q, '^(//|/[*]|#)') AND strlen(q) >= 100), lambda q: strlen(q)"), "strlen(c)")} AS long_string_fraction
        FROM cut)"""


def malformed(x: str) -> str:
    return f"({x} IS NULL OR NOT regexp_matches({x}, '[^{WS}]') OR contains({x}, chr(0)))"


#: Unique documents that are no malformed ones and hold no evaluation text.
ORGANIC = f"{UNIQUE}, {CONTAMINATED}, o AS (SELECT * FROM u WHERE NOT {malformed('content')} AND document_id NOT IN (SELECT document_id FROM dirty))"


VENDOR = "(coalesce(is_vendor, false) OR list_has_any(string_split(replace(lower(coalesce(nullif(file_path, ''), nullif(repo_path, ''), '')), '\\', '/'), '/'), ['vendor', 'node_modules', 'third_party', 'third-party']))"


def generated(x: str) -> str:
    return f"coalesce(regexp_matches({x}, '(?i)generated by|do not edit|auto-generated|webpack|protobuf compiler'), false)"


def secret(x: str) -> str:
    return f"""coalesce(regexp_matches({x}, '(?i)(api[_-]?key|secret|password|token)[{WS}]*[:=][{WS}]*[''"][^''"]{{8,}}[''"]|AKIA[0-9A-Z]{{16}}'), false)"""


def rule_chain(rules: list[Rule], part: str) -> str:
    """CASE over the rules that have a signal in sig; part: reason, signal, value or threshold."""
    out = []
    for r in rules:
        if r.kind == "false":
            continue  # no parser: nothing to reject
        value = {"reason": quoted(r.reason), "signal": quoted(r.signal), "value": f"round({r.signal}::DOUBLE, 9)", "threshold": f"{float(r.threshold)!r}::DOUBLE"}[part]
        out.append(f"WHEN {r.signal} {'<' if r.kind == 'min' else '>'} {r.threshold} THEN {value}")
    return " ".join(out)


TEXT_RULES = [("malformed", "valid_text", 0.0, 1.0), ("vendor", "is_vendor", 1.0, 0.0), ("generated", "generated_marker", 1.0, 0.0), ("secret", "secret_pattern", 1.0, 0.0)]


def judged(part: str, rules: list[Rule], vendor: str = VENDOR) -> str:
    checks = {"malformed": malformed("c"), "vendor": vendor, "generated": generated("c"), "secret": secret("c")}
    at = {"reason": 0, "signal": 1, "value": 2, "threshold": 3}[part]
    first = " ".join(f"WHEN {checks[t[0]]} THEN {quoted(t[at]) if at < 2 else f'{t[at]!r}::DOUBLE'}" for t in TEXT_RULES)
    return f"CASE {first} {rule_chain(rules, part)} END"


QUOTAS = f"""
    cnt AS (SELECT count(*) AS total FROM o),
    br AS (SELECT * FROM (VALUES {", ".join(f"({i}, '{m}', '{t}')" for i, (m, t) in enumerate(BASE_BRANCHES))}) v(branch, model, method)),
    q AS (SELECT branch, model, method, total, round_even(1.5 * total, 0)::BIGINT // 6 + (branch < round_even(1.5 * total, 0)::BIGINT % 6)::BIGINT AS quota FROM br, cnt),
    lc AS (SELECT language, count(*) AS n FROM o GROUP BY language),
    al0 AS (SELECT branch, model, method, language, n, quota, quota * n // total AS whole, quota * n % total AS rest FROM q, lc),
    al AS (SELECT branch, model, method, language, n, whole + (row_number() OVER (PARTITION BY branch ORDER BY rest DESC, language NULLS LAST)
            <= quota - sum(whole) OVER (PARTITION BY branch))::BIGINT AS allocated FROM al0),
    tn AS (SELECT *, row_number() OVER (PARTITION BY language ORDER BY {ORDER}) AS turn FROM o),
    bp AS (SELECT al.model, al.method, tn.*, row_number() OVER (PARTITION BY al.branch ORDER BY turn, tn.language NULLS LAST) AS place
           FROM tn JOIN al ON tn.language IS NOT DISTINCT FROM al.language WHERE turn <= allocated),
    rk AS (SELECT *, coalesce(nullif(repo_id, ''), nullif(repo_path, ''), document_id) AS rkey FROM o WHERE lower(language) = 'python'),
    rt AS (SELECT *, row_number() OVER (PARTITION BY rkey ORDER BY document_id, {ORDER}) AS turn FROM rk),
    ch AS (SELECT *, row_number() OVER (ORDER BY turn, rkey) AS place FROM rt QUALIFY row_number() OVER (ORDER BY turn, rkey) <= 1000),
    par AS (SELECT model, method, document_id, language, content FROM bp
            UNION ALL SELECT m.model, 'codetrace', document_id, language, content FROM ch, (VALUES ('qwen_coder'), ('codegemma')) m(model))"""


def template(text: str) -> str:
    parts = text.replace("{", "\x00{").replace("}", "}\x00").split("\x00")
    return " || ".join(p[1:-1] if p.startswith("{") else quoted(p) for p in parts if p)


MOCK = f"""
    mk0 AS (SELECT *, CASE {" ".join(f"WHEN method = '{k}' THEN {template(v)}" for k, v in MOCK_TEXTS.items())} END AS made FROM par),
    mk AS (SELECT *, {words_between_blanks("made")} AS tokens, 'synthetic:' || model || ':' || method || ':' || document_id AS made_id FROM mk0)"""

MANIFEST = f"""
    og AS (SELECT count(*) AS organic_documents, coalesce(sum(coalesce(token_count, {words_between_blanks("content")})), 0)::BIGINT AS organic_token_count FROM o),
    sy AS (SELECT count(*) AS synthetic_documents, count_if(method = 'codetrace')::BIGINT AS traced, coalesce(sum(tokens), 0)::BIGINT AS synthetic_token_count FROM mk),
    mf AS (SELECT *, round_even(organic_documents * 1.5, 0)::BIGINT AS base, synthetic_documents - traced AS accepted FROM og, sy)"""

PAIRED = """
    per AS (SELECT parent_document_id, coalesce(bool_or(accepted) FILTER (model = 'qwen_coder'), false) AS a, coalesce(bool_or(accepted) FILTER (model = 'codegemma'), false) AS b
            FROM paired_outcomes GROUP BY 1),
    po AS (SELECT count(*) AS attempted, count_if(a)::BIGINT AS first_accepted, count_if(b)::BIGINT AS second_accepted, count_if(a AND b)::BIGINT AS both_succeeded,
            count_if(a AND NOT b)::BIGINT AS first_only, count_if(b AND NOT a)::BIGINT AS second_only, count_if(NOT a AND NOT b)::BIGINT AS neither FROM per)"""


def wilson(s: str, side: int) -> str:
    z = "1.959963984540054"
    p, n = f"({s} / attempted::DOUBLE)", "attempted::DOUBLE"
    scale = f"(1 + {z} * {z} / {n})"
    centre = f"(({p} + {z} * {z} / (2 * {n})) / {scale})"
    half = f"({z} * sqrt({p} * (1 - {p}) / {n} + {z} * {z} / (4 * {n} * {n})) / {scale})"
    return f"greatest(0.0, {centre} - {half})" if side < 0 else f"least(1.0, {centre} + {half})"


P_VALUE = """CASE WHEN first_only + second_only = 0 THEN 1.0 ELSE least(1.0, 2 * (SELECT sum(exp(lgamma(m + 1) - lgamma(k + 1) - lgamma(m - k + 1) - m * ln(2)))
    FROM (SELECT unnest(range(0, least(first_only, second_only) + 1)) AS k, first_only + second_only AS m))) END"""

TRACES = """tr AS (SELECT DISTINCT document_id, model, CASE WHEN contains(content, 'Assistant:' || chr(10)) THEN substr(content, strpos(content, 'Assistant:' || chr(10)) + 11) ELSE content END AS t
    FROM synthetic_documents WHERE method = 'codetrace'),
    ev AS (SELECT *, coalesce(regexp_extract_all(t, '(?m)^TRACE:(IN|OUT|VAR|BRANCH|LOOP|ERR|TRANSFORM):', 1), []) AS events FROM tr)"""



def stripped(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS}]+|[{WS}]+$', '', 'g')"


def right_stripped(x: str) -> str:
    return f"regexp_replace({x}, '[{WS}]+$', '')"


def fenced(x: str, label: str) -> str:
    """Inside of the first fenced block of a language or without one, else the text."""
    pattern = quoted(f"(?s)```(?i:{label})?[{WS}]*(.*?)```")
    return f"CASE WHEN regexp_matches({x}, {pattern}) THEN regexp_extract({x}, {pattern}, 1) ELSE {x} END"


WHOLE_FENCE = quoted(f"(?s)[{WS}]*```[^\\n]*\\n(.*?)\\n```[{WS}]*")

ORACLE: dict[str, str] = {
    "exact_dedup": f"""WITH {UNIQUE} SELECT document_id, source_shard, content_hash FROM u""",
    "normalize_hash": f"SELECT doc_id, length({norm('text')})::INT AS n_characters, sha256({norm('text')}) AS hash FROM documents",
    "shingle_stats": f"""WITH t AS (SELECT document_id, {tokens_of("content")} AS t FROM evaluation_documents)
        SELECT document_id, len(t) AS n_tokens, len(CASE WHEN len(t) < 5 THEN [array_to_string(t, ' ')] ELSE
            list_distinct(list_transform(range(1, len(t) - 3), lambda i: array_to_string(list_slice(t, i, i + 4), ' '))) END) AS n_shingles FROM t""",
    "near_dup_pairs": f"WITH {UNIQUE}, {similar('u', 0.8)} SELECT a, b, round(similarity, 9) AS similarity FROM pairs",
    "near_dedup": f"WITH RECURSIVE {UNIQUE}, {similar('u', 0.8)}, {GREEDY} SELECT document_id FROM u WHERE document_id NOT IN (SELECT k FROM gone)",
    "near_dedup_generated": f"""WITH RECURSIVE s AS (SELECT document_id, any_value(content) AS content FROM synthetic_documents GROUP BY 1), {similar('s', 0.8)}, {GREEDY}
        SELECT document_id FROM s WHERE document_id NOT IN (SELECT k FROM gone)""",
    "cross_dedup": f"""WITH RECURSIVE {UNIQUE}, s AS (SELECT document_id, any_value(content) AS content FROM synthetic_documents GROUP BY 1),
        src AS (SELECT document_id, content FROM u WHERE content IS NOT NULL UNION ALL SELECT document_id, content FROM s WHERE content IS NOT NULL), {similar("src", 0.8).replace("pairs AS", "close AS")},
        own AS (SELECT document_id, {norm("coalesce(content, '')")} AS t FROM s),
        against AS (SELECT document_id FROM own WHERE t IN (SELECT {norm("coalesce(content, '')")} FROM u) UNION SELECT b FROM close WHERE a IN (SELECT document_id FROM u) AND b IN (SELECT document_id FROM s)),
        rest AS (SELECT * FROM own WHERE document_id NOT IN (SELECT document_id FROM against)),
        pairs AS (SELECT a, b FROM close WHERE a IN (SELECT document_id FROM rest) AND b IN (SELECT document_id FROM rest)
            UNION SELECT x.document_id, y.document_id FROM rest x JOIN rest y ON x.t = y.t AND x.document_id < y.document_id), {GREEDY}
        SELECT document_id, CASE WHEN document_id IN (SELECT document_id FROM against) OR document_id IN (SELECT k FROM gone) THEN 'duplicate_against_organic_or_branch' END AS rejection_reason FROM s""",
    "decontaminate": f"""WITH {UNIQUE}, {CONTAMINATED} SELECT document_id, CASE WHEN document_id IN (SELECT document_id FROM dirty) THEN 'evaluation_contamination' END AS rejection_reason FROM u""",
    "quality_text_signals": f"WITH {UNIQUE}, {signals('u', 'rid')} SELECT document_id, num_characters, num_bytes, num_words, num_lines, max_line_length, coalesce(parse_supported, false) AS parse_supported FROM u LEFT JOIN sig USING (rid)",
    "quality_ratio_signals": f"""WITH {UNIQUE}, {signals("u", "rid")} SELECT document_id, {
        ", ".join(f"round({c}, 9) AS {c}" for c in ("mean_word_length", "mean_line_length", "replacement_character_fraction", "duplicate_line_fraction", "alphabetic_fraction", "numeric_fraction", "whitespace_fraction", "encoded_data_fraction"))
    } FROM u LEFT JOIN sig USING (rid)""",
    "ngram_signals": f"WITH {UNIQUE}, {signals('u', 'rid')} SELECT document_id, {', '.join(f'round(top_{k}gram_fraction, 9) AS top_{k}gram_fraction' for k in (2, 3, 4))} FROM u LEFT JOIN sig USING (rid)",
    "lexical_signals": f"WITH {UNIQUE}, {signals('u', 'rid')} SELECT document_id, round(comment_fraction, 9) AS comment_fraction, round(long_string_fraction, 9) AS long_string_fraction FROM u LEFT JOIN sig USING (rid)",
    "text_screens": f"SELECT document_id, source_shard, {malformed('content')} AS malformed, {VENDOR} AS vendor, {generated('content')} AS generated, {secret('content')} AS secret FROM code_documents",
    "quality_rejections": f"""WITH {UNIQUE}, {signals("u", "rid")} SELECT document_id, {", ".join(f"{judged(p, RULES)} AS rejection_{p}" for p in ("reason", "signal", "value", "threshold"))}
        FROM u LEFT JOIN sig USING (rid)""",
    "rejection_summary": f"""WITH d AS (SELECT doc_id::VARCHAR AS document_id, text AS content, lang AS language FROM documents), {signals("d")}
        SELECT coalesce({judged("reason", PROSE_RULES, "false")}, 'accepted') AS reason, count(*) AS n_documents FROM d LEFT JOIN sig USING (document_id) GROUP BY 1""",
    "curation_summary": f"""WITH RECURSIVE {ORGANIC}, {similar("o", 0.8)}, {GREEDY}, k AS (SELECT * FROM o WHERE document_id NOT IN (SELECT k FROM gone)), {signals("k")}
        SELECT coalesce({judged("reason", RULES)}, 'accepted') AS reason, count(*) AS n_documents FROM sig JOIN k USING (document_id) GROUP BY 1""",
    "branch_quotas": f"WITH {ORGANIC}, {QUOTAS} SELECT branch, model, method, quota FROM q",
    "language_allocations": f"WITH {ORGANIC}, {QUOTAS} SELECT model, method, language, n, allocated FROM al",
    "branch_selection": f"WITH {ORGANIC}, {QUOTAS} SELECT model, method, place, document_id FROM bp",
    "trace_cohort": f"WITH {ORGANIC}, {QUOTAS} SELECT place, document_id FROM ch",
    "mock_branches": f"""WITH {ORGANIC}, {QUOTAS}, {MOCK} SELECT made_id AS document_id, document_id AS parent_document_id, model, method,
        CASE model {" ".join(f"WHEN '{k}' THEN '{v}'" for k, v in MODEL_VERSIONS.items())} END AS model_version, tokens AS token_count, true AS mock, true AS synthetic, sha256(made) AS hash FROM mk""",
    "prompts": f"""WITH {ORGANIC}, {QUOTAS} SELECT model, method, document_id, sha256('Prompt version: v1' || chr(10) || CASE method {
        " ".join(f"WHEN '{k}' THEN {quoted(v)}" for k, v in PROMPTS.items())
    } END || chr(10) || 'Language: ' || language || chr(10) || chr(10) || 'Source code:' || chr(10) || content) AS hash FROM par""",
    "merged_corpus": f"""WITH {ORGANIC}, {QUOTAS}, {MOCK}, b AS (SELECT false AS synthetic, language, {words_between_blanks("content")} AS t FROM o UNION ALL SELECT true, language, tokens FROM mk)
        SELECT synthetic, lower(language) AS language, count(*) AS n_documents, sum(t)::BIGINT AS n_tokens FROM b GROUP BY 1, 2""",
    "manifest_counts": f"""WITH {ORGANIC}, {QUOTAS}, {MOCK}, {MANIFEST} SELECT organic_documents, synthetic_documents, base AS base_synthetic_target_documents, accepted AS base_synthetic_accepted_documents,
        greatest(0, base - accepted) AS base_synthetic_shortfall_documents, 1000::BIGINT AS codetrace_pilot_target_per_model, 2000::BIGINT AS codetrace_pilot_target_documents, traced AS codetrace_pilot_accepted_documents,
        greatest(0, 2000 - traced) AS codetrace_pilot_shortfall_documents, base + 2000 AS synthetic_target_documents, greatest(0, base + 2000 - synthetic_documents) AS synthetic_shortfall_documents,
        organic_documents + synthetic_documents AS total_documents, organic_token_count, synthetic_token_count,
        CASE WHEN base + 2000 > synthetic_documents THEN 'completed_with_shortfalls' ELSE 'completed' END AS status FROM mf""",
    "synthetic_by_branch": "SELECT model, method, count(*) AS n_documents FROM synthetic_documents GROUP BY 1, 2",
    "documents_by_language": "SELECT language, count(*) AS n_documents FROM code_documents GROUP BY 1",
    "paired_outcomes": f"WITH {PAIRED} SELECT * FROM po",
    "paired_comparison": f"""WITH {PAIRED} SELECT round(first_accepted / attempted::DOUBLE, 9) AS first_rate, round(second_accepted / attempted::DOUBLE, 9) AS second_rate,
        round(first_accepted / attempted::DOUBLE - second_accepted / attempted::DOUBLE, 9) AS rate_difference, round({P_VALUE}, 9) AS p_value,
        round({wilson("first_accepted", -1)}, 9) AS first_low, round({wilson("first_accepted", 1)}, 9) AS first_high,
        round({wilson("second_accepted", -1)}, 9) AS second_low, round({wilson("second_accepted", 1)}, 9) AS second_high,
        abs(first_accepted / attempted::DOUBLE - second_accepted / attempted::DOUBLE) >= 0.05 AND {P_VALUE} < 0.05 AS clear_difference FROM po""",
    "unique_repositories": "SELECT count(DISTINCT coalesce(nullif(repo_id, ''), repo_path)) + (count_if(coalesce(nullif(repo_id, ''), repo_path) IS NULL) > 0)::BIGINT AS n_repositories, count(*) AS n_documents FROM code_documents",
    "trace_metrics": f"""WITH {TRACES} SELECT document_id, len(regexp_extract_all(t, '(?m)^===STDERR:[^:]+:START===$')) AS trace_files, len(events) AS trace_events, length(t) AS trace_characters,
        round(coalesce(list_max(map_values(list_histogram(events))), 0)::DOUBLE / greatest(len(events), 1)::DOUBLE, 9) AS largest_event_type_fraction FROM ev WHERE t IS NOT NULL""",
    "median_trace_events": f"WITH {TRACES} SELECT model, list_sort(list(len(events)))[(count(*) // 2 + 1)::INT] AS median_trace_events FROM ev GROUP BY 1",
    "ingest_repositories": """SELECT DISTINCT f.content_id AS content_id, 1::BIGINT AS n FROM (SELECT unnest(files) AS f FROM repositories) WHERE f.content <> '' AND f.content_id <> ''""",
    "ingest_languages": """SELECT f.language AS language, count(*) AS n_files, count(DISTINCT coalesce(repo_id::VARCHAR, 'None') || ':' || coalesce(f.file_path, 'None') || ':' || f.content_id) AS n_ids,
        count_if(coalesce(f.is_vendor, false))::BIGINT AS n_vendor, coalesce(sum(coalesce(len(f.detected_licenses), 0)), 0)::BIGINT AS n_licenses, count(*) AS n_named
        FROM (SELECT repo_id, unnest(files) AS f FROM repositories) WHERE f.content <> '' AND f.content_id <> '' AND f.language IN ('Markdown', 'JSON', 'YAML', 'Text') GROUP BY 1""",
    "decontaminate_generated": f"""WITH u AS (SELECT document_id, any_value(content) AS content FROM synthetic_documents GROUP BY 1), {CONTAMINATED}
        SELECT document_id, CASE WHEN document_id IN (SELECT document_id FROM dirty) THEN 'evaluation_contamination' END AS rejection_reason FROM u""",
    "record_blocks": f"""WITH s AS (SELECT document_id, any_value(content) AS c FROM synthetic_documents WHERE content IS NOT NULL GROUP BY 1),
        b AS (SELECT document_id, c, {stripped(fenced("c", "python"))} AS p, CASE WHEN regexp_full_match(c, {WHOLE_FENCE}) THEN regexp_extract(c, {WHOLE_FENCE}, 1) ELSE c END AS w, {stripped(fenced("c", "bash"))} AS x FROM s)
        SELECT document_id, sha256(p) AS python, sha256(w) AS unwrapped, sha256(x) AS script,
            CASE WHEN regexp_matches(x, '(?i)\\b(curl|wget|ssh|scp|nc|sudo|docker|podman|pip|apt|brew)\\b') THEN 'execution script contains a forbidden command'
                 WHEN NOT (contains(x, 'trace') AND contains(x, 'source.py')) THEN 'execution script must run source.py and create trace files' END AS error FROM b""",
    "record_texts": f"""WITH s AS (SELECT document_id, any_value(model) AS model, any_value(method) AS method, any_value(content) AS content FROM synthetic_documents
            WHERE content IS NOT NULL AND model IS NOT NULL AND method IS NOT NULL GROUP BY 1)
        SELECT document_id, sha256('# MOCK_SYNTHETIC model=' || model || ' method=' || method || chr(10) || '# This output is deterministic test data, not model inference.' || chr(10) || content) AS mock,
            sha256('User:' || chr(10) || 'You are provided an instrumented source file "source.py" and a bash execution script "run.sh". Trace through the execution and predict the generated trace files.' || chr(10) || chr(10)
                || 'INPUT FILES:' || chr(10) || chr(10) || '---- FILENAME: source.py ----' || chr(10) || chr(10) || {right_stripped("content")} || chr(10) || chr(10) || '---- FILENAME: run.sh ----' || chr(10) || chr(10)
                || {right_stripped("model")} || chr(10) || chr(10) || 'Assistant:' || chr(10) || {right_stripped("method")}) AS record FROM s""",
    "sampling_requirement": """WITH c AS (SELECT count(*) AS n_documents, count(DISTINCT coalesce(nullif(repo_id, ''), repo_path)) + (count_if(coalesce(nullif(repo_id, ''), repo_path) IS NULL) > 0)::BIGINT AS n_repositories FROM code_documents)
        SELECT n_documents, n_repositories, n_documents >= 1000 AND n_repositories >= 200 AS met FROM c""",
}
