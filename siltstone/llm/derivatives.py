"""Parsing with derivatives over token kinds, memoised.

A grammar is a set of hash-consed regular expressions whose leaves may name
other rules. The derivative by a token is again such an expression: what may
follow. Equal expressions share one number, and each (expression, token) is
derived once, so parsing a stream is mostly one table lookup per token. The
empty expression after a token marks it as the first one no sentence has there;
an expression without the empty sentence at the end marks a truncated stream.
"""

from __future__ import annotations

import re
import sys

EMPTY, EPS = 0, 1
#: Expressions a grammar remembers before it starts anew (results stay the same).
REMEMBERED = 600_000

_EBNF = re.compile(r"\s*(?:'([^']*)'|([A-Za-z_]\w*)|(.))")


class Grammar:
    """rules: lines 'name = expression' of 'token', KIND, rule, ( ), |, *, +, ?; later rules replace earlier ones."""

    def __init__(self, rules: str, start: str = "file"):
        self.source: dict[str, str] = {}
        for line in re.sub(r"\n[ \t]+", " ", rules).strip().splitlines():
            name, _, body = line.partition("=")
            if name.strip():
                self.source[name.strip()] = body.strip()
        self.start = start
        self._reset()

    def _reset(self) -> None:
        self.node: list[tuple] = [("empty",), ("eps",)]
        self.null: list[bool] = [False, True]
        self.step: list[dict[str, int]] = [{}, {}]
        self.ids: dict[tuple, int] = {("empty",): 0, ("eps",): 1}
        self.body: dict[str, int] = {}
        self.rule_null = dict.fromkeys(self.source, False)
        self._fix_nullable()
        self.root = self._make("rule", self.start)

    # building

    def _fix_nullable(self) -> None:
        changed = True
        while changed:
            changed = False
            self.node, self.null, self.step = self.node[:2], self.null[:2], self.step[:2]
            self.ids = {("empty",): 0, ("eps",): 1}
            for name, text in self.source.items():
                self.body[name] = self._read(text)
                if self.null[self.body[name]] and not self.rule_null[name]:
                    self.rule_null[name] = changed = True

    def _read(self, text: str) -> int:
        parts = [m.groups() for m in _EBNF.finditer(text)]
        at = 0

        def choice() -> int:
            nonlocal at
            options = [sequence()]
            while at < len(parts) and parts[at][2] == "|":
                at += 1
                options.append(sequence())
            return self.alt(options)

        def sequence() -> int:
            nonlocal at
            items = []
            while at < len(parts) and parts[at][2] not in ("|", ")"):
                literal, name, sign = parts[at]
                at += 1
                if sign == "(":
                    x = choice()
                    at += 1
                elif literal is not None:
                    x = self._make("token", literal)
                elif name in self.source:
                    x = self._make("rule", name)
                else:
                    x = self._make("token", name)
                while at < len(parts) and parts[at][2] in ("*", "+", "?"):
                    sign = parts[at][2]
                    at += 1
                    x = self.alt([EPS, x]) if sign == "?" else self.star(x) if sign == "*" else self.seq(x, self.star(x))
                items.append(x)
            out = EPS
            for x in reversed(items):
                out = self.seq(x, out)
            return out

        return choice()

    def _make(self, *key) -> int:
        found = self.ids.get(key)
        if found is not None:
            return found
        kind = key[0]
        null = {"token": False, "star": True}.get(kind)
        if kind == "seq":
            null = self.null[key[1]] and self.null[key[2]]
        elif kind == "alt":
            null = any(self.null[x] for x in key[1])
        elif kind == "rule":
            null = self.rule_null[key[1]]
        self.ids[key] = n = len(self.node)
        self.node.append(key)
        self.null.append(bool(null))
        self.step.append({})
        return n

    def seq(self, a: int, b: int) -> int:
        if a == EMPTY or b == EMPTY:
            return EMPTY
        if a == EPS:
            return b
        if b == EPS:
            return a
        if self.node[a][0] == "seq":
            return self.seq(self.node[a][1], self.seq(self.node[a][2], b))
        return self._make("seq", a, b)

    def star(self, a: int) -> int:
        return EPS if a in (EMPTY, EPS) else self._make("star", a)

    def alt(self, options: list[int]) -> int:
        flat: set[int] = set()
        for x in options:
            if self.node[x][0] == "alt":
                flat.update(self.node[x][1])
            elif x != EMPTY:
                flat.add(x)
        if not flat:
            return EMPTY
        if len(flat) == 1:
            return flat.pop()
        # options with one tail are written with the tail outside, which keeps expressions small
        tails: dict[int, list[int]] = {}
        for x in flat:
            if self.node[x][0] == "seq":
                tails.setdefault(self.node[x][2], []).append(x)
        for tail, own in tails.items():
            if len(own) > 1:
                rest = flat.difference(own)
                joined = self.seq(self.alt([self.node[x][1] for x in own]), tail)
                return self.alt([*rest, joined]) if rest else joined
        return self._make("alt", tuple(sorted(flat)))

    # derivatives

    def derive(self, x: int, token: str) -> int:
        known = self.step[x].get(token)
        if known is not None:
            return known
        kind, *args = self.node[x]
        if kind == "token":
            out = EPS if args[0] == token else EMPTY
        elif kind == "seq":
            out = self.seq(self.derive(args[0], token), args[1])
            if self.null[args[0]]:
                out = self.alt([out, self.derive(args[1], token)])
        elif kind == "alt":
            out = self.alt([self.derive(y, token) for y in args[0]])
        elif kind == "star":
            out = self.seq(self.derive(args[0], token), x)
        elif kind == "rule":
            out = self.derive(self.body[args[0]], token)
        else:
            out = EMPTY
        self.step[x][token] = out
        return out

    def check(self, kinds: list[str]) -> int | None:
        """None for a sentence; else the index of the failing token, len(kinds) where the stream ends early."""
        if len(self.node) > REMEMBERED:
            self._reset()
        if sys.getrecursionlimit() < 50_000:
            sys.setrecursionlimit(50_000)
        x, step = self.root, self.step
        for i, k in enumerate(kinds):
            y = step[x].get(k)
            if y is None:
                y = self.derive(x, k)
            if not y:
                return i
            x = y
        return None if self.null[x] else len(kinds)
