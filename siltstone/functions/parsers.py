"""Parsers for the signal parse_error, by language.

Python is parsed by its own parser. Other languages are told by whoever has a parser for
them: parser() takes more checks by language, and languages without one stay undecided.
"""

from __future__ import annotations

import ast
from collections.abc import Callable

from siltstone.functions.signals import Parser

#: A check: True where the text has a syntax error.
Check = Callable[[str], bool]


def python_error(text: str) -> bool:
    try:
        ast.parse(text)
    except (SyntaxError, ValueError, RecursionError, MemoryError):
        return True
    return False


def parser(more: dict[str, Check] | None = None) -> Parser:
    """A parser of the languages (in lower case) that have a check; None for a text of any other one."""
    checks = {"python": python_error} | (more or {})

    def run(languages: list[str], texts: list[str]) -> list[bool | None]:
        return [checks[label](text) if label in checks else None for label, text in zip(languages, texts, strict=True)]

    return run
