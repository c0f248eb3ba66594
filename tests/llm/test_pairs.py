import pytest

from siltstone.llm import pairs as P

QUESTION = "What does `load_rows` return when `limit` is 12?"
ANSWER = "It starts from the limit and changes it line by line. The comparison with 12 decides which branch is taken."
RECORDS = {
    "good": (QUESTION, ANSWER, None),
    "quoting": (QUESTION, 'It prints "I cannot help with that" when the input is empty. The value is kept.', None),
    "nothing": (QUESTION, "", "empty"),
    "mark": (QUESTION, "N/A", "empty"),
    "dash": (QUESTION, " — ", "empty"),
    "fence": (QUESTION, "```\n \n```", "empty"),
    "sorry": (QUESTION, "I'm sorry, but I can't help with that request.", "refusal"),
    "leider": ("Was macht `lade` und wann ist das Ergebnis leer?", "Diese Anfrage muss ich leider ablehnen.", "refusal"),
    "again": (QUESTION, QUESTION, "copied"),
    "twice": (QUESTION, f"{QUESTION} {QUESTION.upper()}", "copied"),
    "lead": (QUESTION, f"Here is the answer: {QUESTION.lower().rstrip('?')}", "copied"),
    "spanish": (QUESTION, "No hay salida temprana, de modo que el coste crece con el bucle. La comparación decide qué rama se toma.", "language"),
    "german": ("¿Por qué `carga` guarda un valor y no una lista?", "Das Ergebnis hängt von der Liste nur über die erste Zuweisung ab.", "language"),
    "cutword": (QUESTION, ANSWER[:-9], "truncated"),
    "cutcode": (QUESTION, "It loops.\n```python\ndef load_rows(limit):\n    for i in range(lim", "truncated"),
    "code": (QUESTION, "```python\ndef load_rows(limit):\n    return limit\n```", None),
}


@pytest.mark.parametrize("layout", ["Question: {q}\nCode:\nx = 1\nAnswer: {a}", "### Question\n{q}\n\n### Code\n```\nx = 1\n```\n\n### Answer\n{a}", "**Question**\n\n{q}\n\n**Code**\n\nx = 1\n\n**Answer**\n\n{a}", "Frage:\n{q}\nAntwort:\n{a}"])
def test_defects(spark, layout):
    rows = [(k, layout.format(q=q, a=a)) for k, (q, a, _) in RECORDS.items()]
    usual = [(f"u{i}", layout.format(q=QUESTION, a=f"{ANSWER} In short: only `name{i}`")) for i in range(6)]
    df = spark.createDataFrame(rows + usual + [("null", None), ("plain", "no sections at all")], "document_id string, content string")
    surveyed = P.survey(df, ["document_id"])
    out = {r["document_id"]: r["defect"] for r in P.defects(P.inspect(surveyed), P.end_counts(surveyed)).collect()}
    assert {k: out[k] for k in RECORDS} == {k: d for k, (_, _, d) in RECORDS.items()}
    assert all(out[f"u{i}"] is None for i in range(6)) and out["null"] == out["plain"] == "empty"


def test_empty_table(spark):
    df = spark.createDataFrame([], "document_id string, content string")
    surveyed = P.survey(df, ["document_id"])
    assert P.defects(P.inspect(surveyed), P.end_counts(surveyed)).count() == 0


def test_sections_and_languages():
    assert P.sections("Task: a\nSource:\nb\nSolution:\nc\nd") == ("a", "b", "c\nd")
    assert P.sections(None) == ("", "", None) and P.sections("Answer: x")[2] == "x"
    assert P.language_of("the value is kept and the list is not") == "en" and P.language_of("x y z") is None
    assert P.surely_ended("a```\nb") is False and P.surely_ended("It is.") is True and P.surely_ended("so on...") is None
