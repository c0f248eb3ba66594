"""Token kinds and grammars of the languages whose files are checked.

Each language has a lexer (one regular expression, so that a file is split in
one pass) and a grammar over the token kinds. Names of rules are lower case,
token classes upper case; keywords and signs stand for themselves.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable
from functools import cache

from siltstone.llm.derivatives import Grammar

ERROR = "ERROR"
#: Kinds that stand for the end of a line.
LINE_ENDS = {";", "NEWLINE", "SEP"}


class Language:
    def __init__(self, grammar: str, keywords: str, signs: str, skip: list[str], strings: list[str], name: str = r"[^\W\d]\w*", number: str | None = None, groups: dict[str, str] | None = None, layout: Callable | None = None, before: list[tuple[str, str]] | None = None, tell: dict[str, str] | None = None):
        self.grammar = Grammar(grammar)
        self.words = {w: w for w in keywords.split()}
        self.signs = {s: s for s in signs.split()}
        for kind, members in (groups or {}).items():
            for s in members.split():
                (self.words if s in self.words or s[0].isalpha() else self.signs)[s] = kind
        number = number or r"\d[\w.]*(?:(?<=[eEpP])[+-][\w.]+)?|\.\d\w*"
        ordered = sorted(self.signs, key=len, reverse=True)
        #: In this order a text is split; None: left out.
        self.classes: list[tuple[str | None, str]] = [(None, s) for s in skip] + list(before or []) + [("STR", s) for s in strings] + [("NUM", number), ("ID", name)]
        if layout:
            self.classes.insert(0, ("\n", r"\n[ \t\n\f]*"))
        body = "|".join([f"(?:{p})" for _, p in self.classes] + [re.escape(s) for s in ordered] + [r"\S"])
        self.finder = re.compile(body)
        # a token by itself has lost its neighbours: classes that look at them are told by other patterns
        self.tests = [(k, re.compile((tell or {}).get(k, p))) for k, p in self.classes]
        self.layout = layout
        self.memory: dict[str, str | None] = {}

    def kind(self, token: str) -> str | None:
        found = self.words.get(token) or self.signs.get(token)
        if not found:
            found = next((k for k, p in self.tests if p.fullmatch(token)), ERROR)
        if len(token) < 40:
            if len(self.memory) > 300_000:
                self.memory.clear()
            self.memory[token] = found
        return found

    def kinds(self, tokens: list[str]) -> list[str]:
        memory, kind, out = self.memory, self.kind, []
        for t in tokens:
            k = memory.get(t, 0)
            if k == 0:
                k = kind(t)
            if k is not None:
                out.append(k)
        return out

    def check(self, text: str) -> tuple[str, int, str] | None:
        """None for a sentence; else ('failing' or 'truncated', its line from 1, the token)."""
        if "\r" in text:
            text = text.replace("\r\n", "\n").replace("\r", "\n")
        if text.startswith("﻿"):
            text = text[1:]
        shift = 0
        if self.layout is indents:
            text, shift = "\n" + text, 1  # the first line may not be indented
        tokens = self.finder.findall(text)
        kinds = self.layout(self, tokens) if self.layout else self.kinds(tokens)
        at = self.grammar.check(kinds)
        if at is None:
            return None
        if at >= len(kinds):
            return "truncated", text.count("\n") + 1 - shift, ""
        line, token = self._place(text, at, kinds[at])
        return "failing", line - shift, token

    def _place(self, text: str, at: int, kind: str) -> tuple[int, str]:
        """Line and text of the token whose kind has this index.

        A kind that stands for a line end is placed at the end of the last line with a token,
        its text being the line end; one for a changed indentation at the token after it.
        """
        found = list(self.finder.finditer(text))
        tokens = [m.group() for m in found]
        marks: list[int] = []
        if self.layout:
            self.layout(self, tokens, marks)
        else:
            n = 0
            for t in tokens:
                marks.append(n)
                n += self.kind(t) is not None
        i = bisect_right(marks, at) - 1
        if kind in LINE_ENDS and not (tokens[i] in (";", "\n") or self.kind(tokens[i]) == kind):
            i = max((j for j in range(i) if tokens[j][0] != "\n" and self.kind(tokens[j]) is not None), default=i)
            return text.count("\n", 0, found[i].end()) + 1, "\n"
        token = tokens[i]
        return text.count("\n", 0, found[i].start()) + 1, "\n" if token[0] == "\n" else token


# Layout: what line ends mean


def semicolons(enders: set[str], openers: set[str], in_brackets: bool = True) -> Callable:
    """A line end closes a statement after an ender, unless the next line begins with an opener."""

    def layout(language: Language, tokens: list[str], marks: list[int] | None = None) -> list[str]:
        memory, kind, out = language.memory, language.kind, []
        stack: list[str] = []
        pending = False
        last = ""
        for t in tokens:
            if marks is not None:
                marks.append(len(out))
            k = memory.get(t, 0)
            if k == 0:
                k = kind(t)
            if k is None:
                continue
            if k == "\n":
                pending = last in enders and not (in_brackets and stack and stack[-1] != "{")
                continue
            if pending:
                pending = False
                if k not in openers:
                    out.append(";")
            if k in ("(", "[", "{"):
                stack.append(k)
            elif k in (")", "]", "}") and stack:
                stack.pop()
            out.append(k)
            last = k
        if last in enders and not stack:
            out.append(";")
        return out

    return layout


def indents(language: Language, tokens: list[str], marks: list[int] | None = None) -> list[str]:
    """NEWLINE, INDENT and DEDENT of a language whose blocks are set off by indentation.

    marks, in all layouts: gets the number of kinds put out before each token.
    """
    memory, kind, out = language.memory, language.kind, []
    levels, depth, pending = [0], 0, None
    for t in tokens:
        if marks is not None:
            marks.append(len(out))
        if t[0] == "\n":
            if not depth:
                tail = t[t.rfind("\n") + 1 :]
                pending = len(tail.replace("\t", "        "))
            continue
        k = memory.get(t, 0)
        if k == 0:
            k = kind(t)
        if k is None:
            continue
        if pending is not None:
            if out:
                out.append("NEWLINE")
            if pending > levels[-1]:
                levels.append(pending)
                out.append("INDENT")
            else:
                while pending < levels[-1]:
                    levels.pop()
                    out.append("DEDENT")
                if pending != levels[-1]:
                    out.append(ERROR)
            pending = None
        if k in ("(", "[", "{"):
            depth += 1
        elif k in (")", "]", "}"):
            depth = max(0, depth - 1)
        out.append(k)
    if out:
        out.append("NEWLINE")
    out.extend("DEDENT" for _ in levels[1:])
    return out


SLASH = [r"//[^\n]*", r"/\*(?:[^*]|\*(?!/))*\*/"]
QUOTED = r'"(?:[^"\\\n]|\\.)*"'
SINGLE = r"'(?:[^'\\\n]|\\.)*'"

# Expressions shared by the languages with braces; e: one expression, es: a list of them.
EXPRESSION = """
e = u (infix u)* ('?' e ':' e)?
infix = BIN | '-' | '+' | '*' | '&' | '=' | ASG | '<' | '>' | '>' '>' | '>' '=' | '>' '>' '=' | '>' '>' '>'
u = PRE u | '-' u | '+' u | '*' u | '&' u | STEP u | p
p = prim tail*
tail = '(' es? ')' | '[' es? ']' | '.' ID | STEP
es = e (',' e)* ','?
"""

C_GRAMMAR = EXPRESSION + """
tail = '(' es? ')' | '[' es? ']' | '.' id | STEP | '{' inits? '}'
prim = name | NUM | STR+ | CHR | '(' es ')' | '(' type ')' u | 'sizeof' '(' type ')' | 'sizeof' u | '{' inits? '}'
inits = init (',' init)* ','?
init = ('.' ID+ | '[' e ']')* '='? e | '.' ID '=' e
id = ID
name = ID
type = spec+ ('*' | CV | '&')* ('[' e? ']')*
block = '{' s* '}'
s = block | ';' | es ';' | decl | 'if' '(' cond ')' s ('else' s)? | 'while' '(' cond ')' s | 'do' s 'while' '(' es ')' ';' | 'for' '(' forhead ')' s | 'switch' '(' cond ')' s | 'case' e ':' | 'default' ':' | 'return' es? ';' | 'break' ';' | 'continue' ';' | 'goto' ID ';' | ID ':' s
cond = es
forhead = (decl | es? ';') es? ';' es?
decl = spec+ (idcl (',' idcl)*)? ';'
idcl = dcl ('=' e)? (':' e)?
dcl = ('*' | CV | '&')* dd
dd = (name | '(' dcl ')') dsuf*
dsuf = '[' e? ']' | '(' params? ')'
params = param (',' param)* (',' '...')?
param = spec+ ('*' | CV | '&')* dd? ('=' e)? | spec+ '*'* dsuf | '...'
spec = CV | MOD | PRIM | ('struct' | 'union') ID? body? | 'enum' ID? enums? | ID
enums = '{' (ID ('=' e)? (',' ID ('=' e)?)* ','?)? '}'
body = '{' decl* '}'
func = spec+ dcl block
file = ext*
ext = func | decl | 'typedef' decl | ';' | MOD STR ('{' ext* '}' | ext)
"""
C_GROUPS = {"BIN": "/ % | ^ || && == != <= <<", "ASG": "+= -= *= /= %= &= |= ^= <<=", "PRE": "! ~", "STEP": "++ --", "CV": "const volatile restrict", "MOD": "static extern inline register auto", "PRIM": "int char float double long short unsigned signed void bool _Bool", ".": ". ->"}
DIRECTIVE = r"(?<![^\n])[ \t]*\#[ \t]*(?:include|define|undef|if|ifdef|ifndef|else|elif|endif|pragma|error|warning|line)\b(?:[^\n\\]|\\.|\\\n)*"
C_SIGNS = "( ) [ ] { } ; , : ? = * & + - < > ... && | ^ || == != <= << / % . -> += -= *= /= %= &= |= ^= <<= ! ~ ++ --"
CHR = r"'(?:[^'\\\n]|\\(?:[^xuU0-7\n]|x[0-9a-fA-F]+|u[0-9a-fA-F]{4}|U[0-9a-fA-F]{8}|[0-7]{1,3}))+'"

CPP_GRAMMAR = C_GRAMMAR + """
infix = BIN | '-' | '+' | '*' | '&' | '&&' | '=' | ASG | '<' | '>' | '>' '>' | '>' '='
u = PRE u | '-' u | '+' u | '*' u | '&' u | STEP u | 'delete' ('[' ']')? u | 'co_await' u | p
tail = '(' es? ')' | '[' es? ']' | ('.' | '->') id | STEP | '{' inits? '}'
prim = name | NUM | STR+ | CHR | '(' es ')' | '(' type ')' u | 'sizeof' '(' type ')' | 'sizeof' u | '{' inits? '}' | 'this' | LIT | PRIM '(' es? ')' | PRIM '{' es? '}' | CAST targs '(' e ')' | lambda | 'new' spec+ '*'* ('(' es? ')' | '[' e ']' | '{' es? '}')? | 'throw' e?
id = 'template'? (ID | PRE ID | 'operator' op) targs?
name = '::'? id ('::' id)*
type = spec+ ('*' | CV | '&' | '&&')* ('[' e? ']')*
s = block | ';' | es ';' | decl | 'if' 'constexpr'? '(' (decl | es ';')? cond ')' s ('else' s)? | 'while' '(' cond ')' s | 'do' s 'while' '(' es ')' ';' | 'for' '(' forhead ')' s | 'switch' '(' cond ')' s | 'case' e ':' | 'default' ':' | 'return' es? ';' | 'break' ';' | 'continue' ';' | 'goto' ID ';' | ID ':' s | 'try' block catch+ | using | 'throw' e? ';'
cond = es | decl2
forhead = (decl | es? ';') es? ';' es? | spec+ dcl ':' e
idcl = dcl fmod* ('=' (e | 'default' | 'delete'))? (':' e)? | dcl '{' inits? '}'
dcl = ('*' | CV | '&' | '&&')* dd
dsuf = '[' e? ']' | '(' params? ')' | '(' es ')'
param = spec+ ('*' | CV | '&' | '&&')* dd? ('=' e)? | spec+ '*'* dsuf | '...'
spec = CV | MOD | PRIM | 'constexpr' | 'typename' | class | 'enum' ('class' | 'struct')? ID? (':' type)? enums? | name | 'decltype' '(' e ')' | attr
func = spec* dcl fmod* (':' minit (',' minit)*)? (block | '=' 'default' ';' | '=' 'delete' ';') | spec* dcl fmod* 'try' block catch+
ext = func | decl | 'typedef' decl | ';' | MOD STR ('{' ext* '}' | ext) | 'namespace' (ID ('::' ID)*)? '{' ext* '}' | using | template ext | 'static_assert' '(' es ')' ';' | dcl ';'
op = BIN | '<' | '>' | '=' | ASG | '*' | '&' | '+' | '-' | PRE | STEP | '(' ')' | '[' ']' | type | '&&'
targs = '<' (targ (',' targ)*)? '>'
targ = type ('(' params? ')')? | e
lambda = '[' (cap (',' cap)*)? ']' ('(' params? ')')? MOD* ('->' type)? block
cap = '&' | '=' | '&'? (ID | 'this') ('=' e)?
decl2 = spec+ dcl '=' e
catch = 'catch' '(' (param | '...') ')' block
attr = '[' '[' e (',' e)* ']' ']'
class = ('class' | 'struct' | 'union') attr? name? 'final'? bases? classbody?
bases = ':' ('public' | 'private' | 'protected' | MOD)* type (',' ('public' | 'private' | 'protected' | MOD)* type)*
classbody = '{' member* '}'
member = ('public' | 'private' | 'protected') ':' | decl | func | using | template member | 'friend' (decl | func) | 'typedef' decl | ';'
fmod = CV | 'noexcept' ('(' e ')')? | 'override' | 'final' | '&' | '&&' | '->' type
minit = name ('(' es? ')' | '{' es? '}')
using = 'using' 'namespace'? name ('=' type)? ';' | 'using' 'typename' name ';'
template = 'template' '<' (tparam (',' tparam)*)? '>'
tparam = ('typename' | 'class') '...'? ID? ('=' type)? | param | template tparam
"""

JAVA_GRAMMAR = EXPRESSION + """
infix = BIN | '-' | '+' | '*' | '&' | '=' | ASG | '<' | '>' | '>' '>' | '>' '=' | '>' '>' '>' | 'instanceof' 'final'?
tail = '(' es? ')' | '[' e ']' | '.' targs? ID | '.' 'class' | '.' 'new' ID '(' es? ')' | '.' 'this' | STEP | '::' (ID | 'new')
prim = name | NUM | STR | CHR | LIT | '(' e ')' | '(' type ('&' type)* ')' u | 'new' type ('(' es? ')' classbody? | ('[' e? ']')+ init?) | lambda | PRIM ('[' ']')* '.' 'class' | 'switch' '(' e ')' swbody | type '::' (ID | 'new') | init
name = ID | 'this' | 'super'
lambda = (ID | '(' lparams? ')') '->' (e | block)
lparams = ID (',' ID)* | param (',' param)*
init = '{' (e (',' e)* ','?)? '}'
type = annot* (PRIM | ID targs? ('.' ID targs?)*) (annot* '[' ']')*
targs = '<' (targ (',' targ)*)? '>'
targ = type | '?' (('extends' | 'super') type)?
annot = '@' ID ('.' ID)* ('(' (aval (',' aval)*)? ')')?
aval = ID '=' e | e | annot
mods = (MOD | annot | 'default' | 'final')*
tparams = '<' tparam (',' tparam)* '>'
tparam = ID ('extends' type ('&' type)*)?
block = '{' s* '}'
vars = mods type var (',' var)*
var = ID ('[' ']')* ('=' e)?
s = block | ';' | e ';' | vars ';' | class | 'if' '(' e ')' s ('else' s)? | 'while' '(' e ')' s | 'do' s 'while' '(' e ')' ';' | 'for' '(' forhead ')' s | 'switch' '(' e ')' swbody | 'return' e? ';' | 'break' ID? ';' | 'continue' ID? ';' | 'throw' e ';' | 'try' ('(' res (';' res)* ';'? ')')? block catch* ('finally' block)? | 'synchronized' '(' e ')' block | ID ':' s | 'assert' e (':' e)? ';' | ID e ';'
res = vars | e
forhead = (vars | es)? ';' e? ';' es? | mods type ID ':' e
catch = 'catch' '(' mods type (BIN type)* ID ')' block
swbody = '{' (('case' es | 'default') (':' s* | '->' (e ';' | block | s)))* '}'
class = mods ('class' | 'interface' | 'enum' | 'record' | '@' 'interface') ID tparams? ('(' params? ')')? ('extends' type (',' type)*)? ('implements' type (',' type)*)? ('permits' type (',' type)*)? classbody
classbody = '{' (consts ';'?)? member* '}'
consts = const (',' const)* ','?
const = annot* ID ('(' es? ')')? classbody?
member = ';' | MOD? block | vars ';' | class | mods tparams? type? ID '(' params? ')' ('[' ']')* ('throws' type (',' type)*)? (block | ';' | 'default' e ';') | mods ID block
params = param (',' param)*
param = mods type '...'? (ID | 'this') ('[' ']')*
file = (annot* 'package' ID ('.' ID)* ';')? ('import' MOD? ID ('.' (ID | '*'))* ';' | ';')* (class | ';')*
"""
JAVA_WORDS = "package import class interface enum record extends implements permits throws if else while do for switch case default return break continue throw try catch finally synchronized assert new this super instanceof final"
JAVA_GROUPS = {"BIN": "/ % | ^ || && == != <= <<", "ASG": "+= -= *= /= %= &= |= ^= <<=", "PRE": "! ~", "STEP": "++ --", "MOD": "public private protected static abstract native transient volatile strictfp sealed", "PRIM": "int char float double long short byte boolean void var", "LIT": "true false null"}
JAVA_SIGNS = "( ) [ ] { } ; , : :: ? = * & + - < > ... @ -> . " + " ".join(JAVA_GROUPS[k] for k in ("BIN", "ASG", "PRE", "STEP"))
TEXT_BLOCK = r'"""(?:[^"\\]|\\.|"(?!""))*"""'

CS_GRAMMAR = EXPRESSION + """
infix = BIN | '-' | '+' | '*' | '&' | '=' | ASG | '<' | '>' | '>' '>' | '>' '=' | '??' | '=>' | 'is' ID? | 'as' | '..'
u = PRE u | '-' u | '+' u | '*' u | '&' u | STEP u | 'await' u | 'throw' u | p
tail = '(' args? ')' | '[' args? ']' | '.' name | '?' '.' name | '?' '[' args ']' | STEP | PRE | init | 'switch' '{' (e '=>' e (',' e '=>' e)* ','?)? '}' | ID init
prim = name | NUM | STR | CHR | LIT | '(' arg (',' arg)* ')' | '(' type ')' u | 'new' type? ('(' args? ')')? (init | ('[' es? ']')+ init?)? | 'async'? (ID | '(' params? ')' | '(' ID (',' ID)* ')') '=>' (e | block) | ('typeof' | 'nameof' | 'sizeof' | 'default' | 'checked') ('(' type ')' | '(' e ')')? | PRIM | 'delegate' ('(' params? ')')? block | '[' es? ']'
name = ID targs? | 'this' | 'base' | ID '::' ID
args = arg (',' arg)* ','?
arg = (ID ':')? ('ref' | 'out' | 'in')? (e | type ID)
init = '{' (ielem (',' ielem)* ','?)? '}'
ielem = e | '[' es ']' '=' e | init
targs = '<' (type? (',' type?)*) '>'
type = ('ref' | 'readonly')* (PRIM | ID targs? (('.' | '::') ID targs?)* | '(' type ID? (',' type ID?)+ ')') ('?' | '*' | '[' ','* ']')*
attr = '[' (ID ':')? e (',' e)* ','? ']'
mods = (attr | MOD | 'new' | 'ref' | 'async' | 'const' | 'readonly')*
block = '{' s* '}'
vars = ('const' | 'using' | 'await')* type var (',' var)*
var = ID ('=' (e | init))?
s = block | ';' | e ';' | vars ';' | localfn | 'if' '(' e ')' s ('else' s)? | 'while' '(' e ')' s | 'do' s 'while' '(' e ')' ';' | 'for' '(' forhead ')' s | 'await'? 'foreach' '(' type ID 'in' e ')' s | 'switch' '(' e ')' swbody | 'return' e? ';' | 'break' ';' | 'continue' ';' | 'throw' e? ';' | 'try' block catch* ('finally' block)? | 'lock' '(' e ')' s | 'using' '(' (vars | e) ')' s | 'yield' ('return' e | 'break') ';' | ID ':' s | 'goto' (ID | 'case' e | 'default') ';' | ('unsafe' | 'checked' | 'unchecked') block | 'fixed' '(' vars ')' s
localfn = mods type ID tparams? '(' params? ')' where* fbody
forhead = (vars | es)? ';' e? ';' es?
catch = 'catch' ('(' type ID? ')')? (ID '(' e ')')? block
swbody = '{' (('case' e (ID e)? | 'default') ':' s*)* '}'
tparams = '<' ('in' | 'out' | attr)* ID (',' ('in' | 'out' | attr)* ID)* '>'
where = ID ID ':' (type | 'class' | 'struct' | 'new' '(' ')') (',' (type | 'class' | 'struct' | 'new' '(' ')'))*
class = mods ('class' | 'struct' | 'interface' | 'record' ('class' | 'struct')?) ID tparams? ('(' params? ')')? (':' type ('(' args? ')')? (',' type)*)? where* ('{' member* '}' ';'? | ';') | mods 'enum' ID (':' type)? '{' (attr* ID ('=' e)? (',' attr* ID ('=' e)?)* ','?)? '}' ';'? | mods 'delegate' type ID tparams? '(' params? ')' where* ';'
member = class | mods type var (',' var)* ';' | mods 'event' type (var ';' | ID '{' acc* '}') | mods type name ('.' name)* '{' acc* '}' ('=' (e | init) ';')? | mods type ID '=>' e ';' | mods type 'this' '[' params ']' ('{' acc* '}' | '=>' e ';') | mods type name ('.' name)* tparams? '(' params? ')' where* fbody | mods PRE? ID '(' params? ')' (':' ('base' | 'this') '(' args? ')')? fbody | mods type 'operator' (BIN | PRE | STEP | '+' | '-' | '*' | '&' | '<' | '>' ) '(' params ')' fbody | mods ('implicit' | 'explicit') 'operator' type '(' params ')' fbody
fbody = block | '=>' e ';' | ';'
acc = mods ID fbody
params = param (',' param)*
param = attr* ('ref' | 'out' | 'in' | 'params' | 'this')* type ID ('=' e)?
file = ('extern' ID ID ';')* use* (ns | class | ';' | attr | s)*
use = ID? 'using' MOD? (ID '=')? type ';'
ns = 'namespace' ID ('.' ID)* (';' | '{' use* (ns | class)* '}' ';'?)
"""
CS_WORDS = "using namespace class struct interface record enum delegate event if else while do for foreach in switch case default return break continue throw try catch finally lock yield new this base is as await async const readonly typeof nameof sizeof ref out params operator implicit explicit checked unchecked unsafe fixed goto extern"
CS_GROUPS = {"BIN": "/ % | ^ || && == != <= <<", "ASG": "+= -= *= /= %= &= |= ^= <<= ??=", "PRE": "! ~", "STEP": "++ --", "MOD": "public private protected internal static abstract sealed virtual override partial volatile required", "PRIM": "int char float double long short byte bool void var string object decimal uint ulong ushort sbyte dynamic", "LIT": "true false null"}
CS_SIGNS = "( ) [ ] { } ; , : :: ? = * & + - < > => ?? .. . " + " ".join(CS_GROUPS[k] for k in ("BIN", "ASG", "PRE", "STEP"))

GO_GRAMMAR = """
e = u (infix u)*
infix = BIN | '-' | '+' | '*' | '&' | '<' | '>' | '<-'
u = PRE u | '-' u | '+' u | '*' u | '&' u | '<-' u | p
p = prim tail*
prim = ID | NUM | STR | CHR | '(' e ')' | '(' type ')' | 'func' sig block | ctype lit | ctype '(' e ','? ')' | ctype | lit
ctype = '[' (e | '...')? ']' type | 'map' '[' type ']' type | 'struct' '{' fields '}' | 'chan' '<-'? type | 'interface' '{' imembers '}'
tail = '(' ((e | type) (',' (e | type))* '...'? ','?)? ')' | '[' e? (':' e?)* ']' | '[' type (',' type)* ']' | '.' ID | '.' '(' (type | 'type') ')' | lit
lit = '{' (elem (',' elem)* ','?)? '}'
elem = (e ':')? e
type = ID ('.' ID)? ('[' type (',' type)* ']')? | '*' type | ctype | 'func' sig | '<-' 'chan' type | '(' type ')'
sig = '(' params? ')' (type | '(' params ')')?
params = param (',' param)* ','?
param = (ID (',' ID)*)? '...'? type
fields = (fid (';' fid)* ';'?)?
fid = ID (',' ID)* type STR? | '*'? ID ('.' ID)? STR?
imembers = ((ID sig | type (BIN type)*) (';' (ID sig | type (BIN type)*))* ';'?)?
block = '{' list '}'
list = s? (';' s?)*
es = e (',' e)*
simple = es | es (':=' | '=' | ASG) 'range'? es | e STEP | 'range' e
s = simple | decl | block | 'if' (simple? ';')? simple block ('else' (block | ifs))? | 'for' ((simple? ';' simple? ';' simple?) | simple)? block | 'switch' (simple? ';')? simple? '{' cases '}' | 'select' '{' cases '}' | 'return' es? | BRK ID? | 'goto' ID | ('go' | 'defer') e | ID ':' s?
ifs = 'if' (simple? ';')? simple block ('else' (block | ifs))?
cases = (('case' (es | simple | type (',' type)*) | 'default') ':' list)*
decl = 'var' (var | '(' (var (';' var)* ';'?)? ')') | 'const' (var | '(' (var (';' var)* ';'?)? ')') | 'type' (tdef | '(' (tdef (';' tdef)* ';'?)? ')')
var = ID (',' ID)* type? ('=' es)?
tdef = ID ('[' params ']')? '='? type
func = 'func' ('(' params ')')? ID ('[' params ']')? sig block?
imp = 'import' (spec | '(' (spec (';' spec)* ';'?)? ')')
spec = (ID | '.')? STR
file = 'package' ID ';' (imp ';')* ((decl | func) (';' (decl | func))*)? ';'?
"""
GO_WORDS = "package import func var const type struct interface map chan if else for range switch select case default return goto go defer"
GO_GROUPS = {"BIN": "/ % | ^ || && == != <= >= << >> &^", "ASG": "+= -= *= /= %= &= |= ^= <<= >>=", "PRE": "!", "STEP": "++ --", "BRK": "break continue fallthrough"}
GO_SIGNS = "( ) [ ] { } ; , : := = * & + - < > <- ... . " + " ".join(GO_GROUPS[k] for k in ("BIN", "ASG", "PRE", "STEP"))

JS_GRAMMAR = EXPRESSION + """
e = arrow | 'async' arrow | u (infix u)* ('?' e ':' e)? | u (infix u)* infix arrow | 'yield' '*'? e?
infix = BIN | '-' | '+' | '*' | '&' | '=' | ASG | '<' | '>' | '>' '>' | '>' '=' | '>' '>' '>' | 'in' | 'instanceof' | '??'
u = PRE u | '-' u | '+' u | STEP u | 'await' u | p
tail = '(' spreads? ')' | '[' es ']' | '.' key | '?.' (key | '(' spreads? ')' | '[' e ']') | STEP | STR
es = e (',' e)*
arrow = (id | '(' params? ')') '=>' (e | block)
prim = id | NUM | STR | REGEX | LIT | 'this' | 'super' | '(' es ')' | '[' elems ']' | '{' props? '}' | 'async'? 'function' '*'? id? '(' params? ')' block | class | 'new' prim ('.' key)* ('(' es? ')')? | 'import' '(' e ')' | 'import' '.' ID | 'new' '.' ID
spreads = spread (',' spread)* ','?
spread = '...'? e
elems = (spread | ',')*
props = prop (',' prop)* ','?
prop = '...' e | pkey ':' e | id ('=' e)? | ('async' | 'get' | 'set' | '*')* pkey '(' params? ')' block
pkey = key | STR | NUM | '[' e ']'
id = ID | 'async' | 'get' | 'set' | 'of' | 'from' | 'as' | 'static'
key = id | 'var' | 'let' | 'const' | 'function' | 'class' | 'extends' | 'return' | 'throw' | 'break' | 'continue' | 'do' | 'while' | 'for' | 'if' | 'else' | 'switch' | 'case' | 'default' | 'try' | 'catch' | 'finally' | 'import' | 'export' | 'new' | 'this' | 'in' | 'instanceof' | 'await' | LIT | 'super' | 'yield' | PRE
params = par (',' par)* ','?
par = '...'? bind ('=' e)?
bind = id | '[' (par | ',')* ']' | '{' (bprop (',' bprop)* ','?)? '}'
bprop = '...' id | pkey (':' bind)? ('=' e)?
block = '{' s* bare? '}'
bare = simple
simple = es | ('var' | 'let' | 'const') decls | 'return' es? | 'throw' es | 'break' id? | 'continue' id? | 'debugger' | 'do' s 'while' '(' es ')'
decls = bind ('=' e)? (',' bind ('=' e)?)*
s = simple ';' | 'do' s 'while' '(' es ')' | ';' | block | fun | class | 'if' '(' es ')' sb ('else' sb)? | 'while' '(' es ')' sb | 'for' 'await'? '(' forhead ')' sb | 'switch' '(' es ')' '{' (('case' es | 'default') ':' s* bare?)* '}' | 'try' block ('catch' ('(' bind ')')? block)? ('finally' block)? | id ':' s | impexp
sb = s | bare
forhead = (('var' | 'let' | 'const') decls | es)? ';' es? ';' es? | (('var' | 'let' | 'const') bind | e) ('of' | 'in') es
fun = 'async'? 'function' '*'? id '(' params? ')' block
class = 'class' id? ('extends' u)? '{' member* '}'
member = ';' | mmods pkey '(' params? ')' (block | ';') | mmods pkey ('=' e)? ';' | 'static' block
mmods = ('static' | 'async' | 'get' | 'set' | '*')*
impexp = 'import' (STR | imps 'from' STR) ';' | 'export' ('default' (e ';' | fun | class) | ('var' | 'let' | 'const') decls ';' | fun | class | '*' ('as' id)? 'from' STR ';' | '{' (ims (',' ims)* ','?)? '}' ('from' STR)? ';')
imps = id | '*' 'as' id | '{' (ims (',' ims)* ','?)? '}' | id ',' ('{' (ims (',' ims)* ','?)? '}' | '*' 'as' id)
ims = key ('as' key)?
file = s* bare?
"""
JS_WORDS = "var let const function class extends return throw break continue debugger do while for if else switch case default try catch finally import export new this super in instanceof await yield async get set of from as static"
JS_GROUPS = {"BIN": "/ % | ^ || && == != === !== <= << **", "ASG": "+= -= *= /= %= &= |= ^= <<= **= &&= ||= ??=", "PRE": "! ~ typeof void delete", "STEP": "++ --", "LIT": "true false null undefined"}
JS_SIGNS = "( ) [ ] { } ; , : ? = * & + - < > => ?? ?. ... . / % | ^ || && == != === !== <= << ** += -= *= /= %= &= |= ^= <<= **= &&= ||= ??= ! ~ ++ --"
TEMPLATE = r"`(?:[^`\\]|\\[\s\S])*`"
REGEX = r"(?:(?<=[=(,:\[!&|?{};\n>])|(?<=return)|(?<=typeof)|(?<=case))[ ]?/(?![*/\s])(?:[^/\\\n\[]|\\.|\[(?:[^\]\\\n]|\\.)*\])+/[a-z]*"
REGEX_ALONE = r"[ ]?/.+/[a-z]*"

TS_GRAMMAR = JS_GRAMMAR + """
tail = '(' spreads? ')' | '[' es ']' | '.' key | '?.' (key | '(' spreads? ')' | '[' e ']') | STEP | STR | PRE | 'as' (type | 'const') | targs '(' spreads? ')' | 'satisfies' type
arrow = (id | tparams? '(' params? ')' ret?) '=>' (e | block)
prim = id | NUM | STR | REGEX | LIT | 'this' | 'super' | '(' es ')' | '[' elems ']' | '{' props? '}' | 'async'? 'function' '*'? id? '(' params? ')' ret? block | class | 'new' prim ('.' key)* targs? ('(' es? ')')? | 'import' '(' e ')' | 'import' '.' ID | 'new' '.' ID
prop = '...' e | pkey ':' e | id ('=' e)? | ('async' | 'get' | 'set' | '*')* pkey '(' params? ')' ret? block
id = ID | 'async' | 'get' | 'set' | 'of' | 'from' | 'as' | 'static' | 'type' | 'is' | 'abstract' | 'declare' | 'namespace' | 'readonly' | 'asserts' | 'infer' | 'keyof' | 'satisfies' | 'unique' | 'override' | PRIM
par = deco* acc* '...'? (bind | 'this') '?'? (':' type)? ('=' e)?
ret = ':' ('asserts' | ID 'is')? type
targs = '<' type (',' type)* '>'
decls = bind PRE? (':' type)? ('=' e)? (',' bind PRE? (':' type)? ('=' e)?)*
s = simple ';' | 'do' s 'while' '(' es ')' | ';' | block | fun | class | tdecl | 'if' '(' es ')' sb ('else' sb)? | 'while' '(' es ')' sb | 'for' 'await'? '(' forhead ')' sb | 'switch' '(' es ')' '{' (('case' es | 'default') ':' s* bare?)* '}' | 'try' block ('catch' ('(' bind (':' type)? ')')? block)? ('finally' block)? | id ':' s | impexp
fun = 'async'? 'function' '*'? id tparams? '(' params? ')' ret? (block | ';')
class = deco* 'abstract'? 'class' id? tparams? ('extends' u targs?)? ('implements' type (',' type)*)? '{' member* '}'
member = ';' | deco* mmods pkey ('?' | PRE)? tparams? '(' params? ')' ret? (block | ';') | deco* mmods pkey ('?' | PRE)? (':' type)? ('=' e)? ';' | 'static' block | mmods '[' id ':' type ']' ':' type ';'
mmods = ('static' | 'async' | 'get' | 'set' | '*' | acc | 'abstract' | 'declare')*
impexp = 'import' 'type'? (STR | imps 'from' STR) ';' | 'export' ('default' (e ';' | fun | class | tdecl) | ('var' | 'let' | 'const') decls ';' | fun | class | tdecl | 'type'? '*' ('as' id)? 'from' STR ';' | 'type'? '{' (ims (',' ims)* ','?)? '}' ('from' STR)? ';' | '=' e ';') | 'import' id '=' e ';'
ims = 'type'? key ('as' key)?
acc = 'public' | 'private' | 'protected' | 'readonly' | 'override'
type = 'asserts'? tfun | tu ('extends' type '?' type ':' type)?
tu = ('|' | '&')? tp (('|' | '&') tp)*
tp = ('keyof' | 'readonly' | PRE | 'infer' | 'unique')* tprim ('[' type? ']')*
tprim = (id | PRIM | 'this') ('.' id)* targs? | LIT | STR | '-'? NUM | '{' tmembers '}' | '[' (tel (',' tel)* ','?)? ']' | '(' type ')' | PRE type? | 'import' '(' STR ')' ('.' id)*
tel = '...'? (id '?'? ':')? type '?'?
tfun = 'new'? tparams? '(' params? ')' '=>' (ID 'is')? type
tparams = '<' tparam (',' tparam)* ','? '>'
tparam = 'const'? id ('extends' type)? ('=' type)?
tmembers = (tm ((';' | ',') tm)* (';' | ',')?)?
tm = ('readonly' | '-' | '+')* (pkey '?'? (':' type)? | pkey? '?'? tparams? '(' params? ')' ret? | '[' id (':' | 'in') type ('as' type)? ']' ('-' | '+')? '?'? ':' type | 'new' '(' params? ')' ret? | ('get' | 'set') pkey '(' params? ')' ret?)
deco = '@' p
tdecl = 'declare'? ('interface' id tparams? ('extends' type (',' type)*)? '{' tmembers '}' | 'type' id tparams? '=' type ';' | 'const'? 'enum' id '{' (pkey ('=' e)? (',' pkey ('=' e)?)* ','?)? '}' | ('namespace' (id ('.' id)* | STR)) block) | 'declare' s
"""
TS_WORDS = JS_WORDS + " type interface enum namespace implements abstract declare readonly public private protected override keyof infer unique is asserts satisfies"
TS_GROUPS = JS_GROUPS | {"PRIM": "any unknown never string number boolean object symbol bigint"}
JS_ENDERS = {"ID", "NUM", "STR", "REGEX", "LIT", ")", "]", "}", "return", "break", "continue", "debugger", "this", "super", "STEP", "async", "get", "set", "of", "from", "as", "static", "PRIM", "WORD", "type", "is", "!", "yield"} | set("abstract declare namespace readonly".split())
JS_OPENERS = {".", "?.", "?", ":", "BIN", "ASG", "=", "*", "&", "+", "-", "<", ">", "=>", "??", ",", ")", "]", "}", "(", "[", "in", "instanceof", "else", "catch", "finally", "{", ";", "extends", "implements", "|"}

PHP_GRAMMAR = EXPRESSION + """
e = u (infix u)* ('?' e? ':' e)?
infix = BIN | '-' | '+' | '*' | '&' | '=' '&'? | ASG | '<' | '>' | 'instanceof' | '??' | 'and' | 'or' | '.'
u = PRE u | '-' u | '+' u | '&' u | STEP u | CASTS u | 'new' newexp tail* | 'clone' u | 'print' u | 'yield' ('from'? e ('=>' e)?)? | 'throw' u | INC u | p
tail = '(' args? ')' | '[' e? ']' | '{' e '}' | ARROW (ID | VAR | kw | '{' e '}') | '::' (ID | VAR | 'class' | kw) | STEP
newexp = (name | VAR | 'static') ('(' args? ')')? | 'class' ('(' args? ')')? ext '{' member* '}'
prim = VAR | name | NUM | STR | '(' e ')' | '[' elems? ']' | 'array' '(' elems? ')' | 'list' '(' elems? ')' | 'static'? fn | 'static' | 'isset' '(' es ')' | 'empty' '(' e ')' | 'exit' ('(' e? ')')? | 'match' '(' e ')' '{' (arm (',' arm)* ','?)? '}'
arm = (es | 'default') '=>' e
fn = 'function' '&'? '(' params? ')' ('use' '(' '&'? VAR (',' '&'? VAR)* ','? ')')? ret? block | 'fn' '(' params? ')' ret? '=>' e
kw = 'list' | 'class' | 'print' | 'empty' | 'default' | 'array' | 'match' | 'use' | 'isset' | 'clone' | 'exit' | 'new' | 'static' | 'echo' | 'for' | 'unset'
args = arg (',' arg)* ','?
arg = '...' e? | (ID ':')? e
elems = elem? (',' elem?)*
elem = (e '=>')? '&'? e | '...' e
name = NS? ID (NS ID)*
type = '?'? tp ((BIN | '&') tp)*
tp = name | 'array' | 'static' | '(' type ')'
ret = ':' type
params = param (',' param)* ','?
param = attr* MOD* type? '&'? '...'? VAR ('=' e)?
attr = '#[' es ']'
block = '{' s* '}'
s = block | ';' | e end | 'echo' es end | 'if' '(' e ')' s ('elseif' '(' e ')' s)* ('else' s)? | 'if' '(' e ')' ':' s* ('elseif' '(' e ')' ':' s*)* ('else' ':' s*)? 'endif' end | 'while' '(' e ')' (s | ':' s* 'endwhile' end) | 'do' s 'while' '(' e ')' end | 'for' '(' es? ';' es? ';' es? ')' (s | ':' s* 'endfor' end) | 'foreach' '(' e 'as' (e '=>')? '&'? e ')' (s | ':' s* 'endforeach' end) | 'switch' '(' e ')' '{' (('case' e | 'default') (':' | ';') s*)* '}' | ('break' | 'continue') NUM? end | 'return' e? end | 'global' VAR (',' VAR)* end | 'static' VAR ('=' e)? (',' VAR ('=' e)?)* end | 'unset' '(' es ')' end | 'try' block ('catch' '(' type VAR? ')' block)* ('finally' block)? | func | class | 'const' ID '=' e end | 'namespace' name? (end | block) | 'use' ('function' | 'const')? name usel? (',' name usel?)* end | 'declare' '(' ID '=' e ')' (end | s) | 'goto' ID end
usel = 'as' ID | NS '{' name ('as' ID)? (',' name ('as' ID)?)* ','? '}'
end = ';' | CLOSE
func = attr* 'function' '&'? ID '(' params? ')' ret? block
class = attr* MOD* ('class' | 'interface' | 'trait' | 'enum') ID (':' type)? ext '{' member* '}'
ext = ('extends' name (',' name)*)? ('implements' name (',' name)*)?
member = attr* (MOD | 'static')* type? VAR ('=' e)? (',' VAR ('=' e)?)* ';' | attr* MOD* 'const' type? (ID | kw) '=' e (',' ID '=' e)* ';' | attr* (MOD | 'static')* 'function' '&'? (ID | kw) '(' params? ')' ret? (block | ';') | 'use' name (',' name)* (';' | block) | 'case' ID ('=' e)? ';'
file = (OPEN s* (CLOSE OPEN s*)* CLOSE?)?
"""
PHP_WORDS = "echo if elseif else endif while endwhile do for endfor foreach endforeach as switch case default break continue return global static unset try catch finally function fn class interface trait enum extends implements const namespace use declare goto new clone print yield from throw instanceof array list isset empty exit match and or"
PHP_GROUPS = {"BIN": "/ % | ^ || && == != === !== <= >= << >> ** <=> xor", "ASG": "+= -= *= /= .= %= &= |= ^= <<= >>= **= ??=", "PRE": "! ~ @", "STEP": "++ --", "MOD": "public private protected abstract final readonly var", "INC": "include include_once require require_once", "ARROW": "-> ?->", "NS": "\\", "exit": "die"}
PHP_SIGNS = "( ) [ ] { } ; , : :: ? = * & + - < > => ?? ... . #[ -> ?-> \\ / % | ^ || && == != === !== <= >= << >> ** <=> += -= *= /= .= %= &= |= ^= <<= >>= **= ??= ! ~ @ ++ --"

RUST_GRAMMAR = """
e = 'return' e? | 'break' LIFE? e? | 'continue' LIFE? | closure | u (infix u)* | u (infix u)* infix closure | u? RANGE u?
infix = BIN | '>' '>' | '>' '=' | '-' | '+' | '*' | '&' | '&&' | '=' | ASG | '<' | '>' | RANGE | '|' | '||'
u = '!' u | '-' u | '*' u | '&' 'mut'? u | '&&' 'mut'? u | p
p = prim tail*
prim = path | NUM | STR | CHR | LIT | '(' (e (',' e)* ','?)? ')' | '[' (e (',' e)* ','? | e ';' e)? ']' | blocky | path '{' (finit (',' finit)* ','?)? (',' RANGE e)? '}' | path '!' group
finit = (ID | NUM) (':' e)? | RANGE e
blocky = 'unsafe'? block | 'async' 'move'? block | 'if' cond block ('else' (block | ifs))? | (LIFE ':')? ('loop' block | 'while' cond block | 'for' pat 'in' e block) | 'match' e '{' (arm* last?) '}'
ifs = 'if' cond block ('else' (block | ifs))?
cond = e | 'let' pat '=' e
arm = attr* pat ('if' e)? '=>' (e ',' | block ','? | blocky)
last = attr* pat ('if' e)? '=>' e
closure = 'move'? ('|' (cpar (',' cpar)* ','?)? '|' | '||') (e | '->' type block)
cpar = pat1 (':' type)?
tail = '(' (e (',' e)* ','?)? ')' | '[' e ']' | '.' (ID | NUM | 'await') ('::' targs)? | '?' | 'as' type
path = ('::' | '<' type ('as' type)? '>' '::')? seg ('::' (seg | targs))*
seg = ID | 'self' | 'Self' | 'super' | 'crate'
targs = '<' (targ (',' targ)* ','?)? '>'
targ = type | LIFE | ID '=' type | NUM | block
type = tpath ('+' (tpath | LIFE))* | '&' LIFE? 'mut'? type | '&&' LIFE? 'mut'? type | '*' ('const' | 'mut') type | '[' type (';' e)? ']' | '(' (type (',' type)* ','?)? ')' | ('impl' | 'dyn') bound ('+' bound)* | 'fn' '(' (type (',' type)* ','?)? ')' ('->' type)? | '!' | '_'
tpath = '::'? tseg ('::' tseg)*
tseg = seg (('::')? targs)? | seg '(' (type (',' type)*)? ')' ('->' type)?
bound = '?'? tpath | LIFE | 'for' '<' LIFE '>' tpath
pat = '|'? pat1 ('|' pat1)*
pat1 = '&'* 'mut'? p1
p1 = '_' | ('ref' | 'mut')* ID ('@' pat1)? | '-'? NUM (RANGE '-'? NUM?)? | STR | CHR (RANGE CHR)? | LIT | path ('(' (pat (',' pat)* ','?)? ')' | '{' (fpat (',' fpat)* ','?)? '}')? | '(' (pat (',' pat)* ','?)? ')' | '[' (pat (',' pat)* ','?)? ']' | RANGE
fpat = ('ref' | 'mut')* ID (':' pat)? | RANGE
block = '{' s* e? '}'
s = ';' | 'let' pat (':' type)? ('=' e ('else' block)?)? ';' | e ';' | blocky | item | attr s | path '!' '{' any* '}'
group = '(' any* ')' | '[' any* ']' | '{' any* '}'
any = group | '!' | '#' | '$' | '&' | '&&' | '*' | '+' | ',' | '-' | '->' | '.' | ':' | '::' | ';' | '<' | '=' | '=>' | '>' | '?' | '@' | 'ASG' | 'BIN' | 'CHR' | 'ID' | 'LIFE' | 'LIT' | 'NUM' | 'RANGE' | 'STR' | 'Self' | '_' | 'as' | 'async' | 'await' | 'break' | 'const' | 'continue' | 'crate' | 'dyn' | 'else' | 'enum' | 'extern' | 'fn' | 'for' | 'if' | 'impl' | 'in' | 'let' | 'loop' | 'match' | 'mod' | 'move' | 'mut' | 'pub' | 'ref' | 'return' | 'self' | 'static' | 'struct' | 'super' | 'trait' | 'type' | 'unsafe' | 'use' | 'where' | 'while' | '|' | '||'
attr = '#' '!'? '[' any* ']'
vis = 'pub' ('(' ('in'? path) ')')?
gen = '<' (gpar (',' gpar)* ','?)? '>'
gpar = LIFE (':' LIFE)? | ID (':' bound ('+' bound)*)? ('=' type)? | 'const' ID ':' type
where = 'where' (type ':' bound ('+' bound)* (',' type ':' bound ('+' bound)*)* ','?)
item = attr* vis? ('const' | 'async' | 'unsafe' | 'extern' STR?)* fn | attr* vis? it
fn = 'fn' ID gen? '(' (fpar (',' fpar)* ','?)? ')' ('->' type)? where? (block | ';')
fpar = attr* ('&' LIFE?)? 'mut'? 'self' (':' type)? | attr* pat1 ':' type
it = 'use' use ';' | 'mod' ID (';' | '{' item* '}') | ('const' | 'static' 'mut'?) (ID | '_') ':' type ('=' e)? ';' | 'type' ID gen? (':' bound)? ('=' type)? ';' | 'struct' ID gen? where? (';' | '{' (field (',' field)* ','?)? '}' | '(' (attr* vis? type (',' attr* vis? type)* ','?)? ')' where? ';') | 'enum' ID gen? where? '{' (variant (',' variant)* ','?)? '}' | 'unsafe'? 'trait' ID gen? (':' bound ('+' bound)*)? where? '{' item* '}' | 'unsafe'? 'impl' gen? ('!'? type 'for')? type where? '{' item* '}' | path '!' ID? group ';'? | 'extern' 'crate' ID ('as' ID)? ';' | 'extern' STR? '{' item* '}'
field = attr* vis? ID ':' type
variant = attr* ID ('{' (field (',' field)* ','?)? '}' | '(' (type (',' type)* ','?)? ')')? ('=' e)?
use = '::'? useg ('::' useg)* ('as' (ID | '_'))?
useg = seg | '*' | '{' (use (',' use)* ','?)? '}'
file = attr* item*
"""
RUST_WORDS = "let mut fn if else match while loop for in return break continue struct enum trait impl use mod pub const static type where as move ref unsafe async await dyn extern crate self Self super _"
RUST_GROUPS = {"BIN": "/ % ^ == != <= <<", "ASG": "+= -= *= /= %= &= |= ^= <<=", "RANGE": ".. ..= ...", "LIT": "true false"}
RUST_SIGNS = "( ) [ ] { } ; , : :: = * & && + - < > => -> . | || ! ? @ # $ / % ^ == != <= << += -= *= /= %= &= |= ^= <<= .. ..= ..."

KOTLIN_GRAMMAR = """
e = lam | u (infix u)*
infix = BIN | '-' | '+' | '*' | '=' | ASG | '<' | '>' | '?:' | '..' | '..<' | ID | 'in' | '!in' | 'is' | '!is' | 'as' '?'? | '&&'
u = '!' u | '-' u | '+' u | STEP u | p
p = prim tail*
prim = ID targs? | NUM | STR | CHR | LIT | 'this' ('@' ID)? | 'super' targs? | '(' e ')' | '[' es? ']' | lam | 'if' '(' e ')' sb ';'? ('else' sb)? | 'when' ('(' ('val' ID '=')? e ')')? '{' warm* '}' | 'try' block ('catch' '(' ID ':' type ')' block)* ('finally' block)? | 'object' (':' supers)? cbody | 'fun' '(' params? ')' (':' type)? fbody | 'return' ('@' ID)? e? | 'throw' e | 'break' ('@' ID)? | 'continue' ('@' ID)? | '::' ID | type '::' (ID | 'class')
warm = (('else' | wcond (',' wcond)* ','?) '->' sb) ';'?
wcond = e | ('in' | '!in') e | ('is' | '!is') type
lam = '{' ((lp (',' lp)* ','?)? '->')? list '}'
lp = ID (':' type)? | '(' ID (',' ID)* ')'
tail = '(' args? ')' | '[' es ']' | ('.' | '?.') (ID | 'class') targs? | STEP | '!!' | lam | '::' (ID | 'class')
args = arg (',' arg)* ','?
arg = (ID '=')? '*'? e
es = e (',' e)* ','?
targs = '<' targ (',' targ)* '>'
targ = '*' | ('in' | MOD)? type
type = annot* (MOD? ('(' (type (',' type)*)? ')' '->' type) | ID targs? ('.' ID targs?)* | '(' type ')') '?'* | ID targs? '.' '(' (type (',' type)*)? ')' '->' type
annot = '@' (ID ':')? ID ('.' ID)* ('(' args? ')')?
mods = (MOD | annot)*
block = '{' list '}'
list = s? (';' s?)*
sb = block | e | s
s = e | decl | 'for' '(' annot* (ID (':' type)? | '(' ID (',' ID)* ')') 'in' e ')' sb? | 'while' '(' e ')' sb? | 'do' sb 'while' '(' e ')' | ID '@' s
decl = mods 'fun' tpars? (type '.')? ID? '(' params? ')' (':' type)? where? fbody? | mods ('val' | 'var') tpars? (type '.')? (ID | '(' ID (',' ID)* ')') (':' type)? ('=' e | 'by' e)? acc* | mods ('class' | 'interface') ID tpars? (mods 'constructor'? '(' cparams? ')')? (':' supers)? where? cbody? | mods 'object' ID? (':' supers)? cbody? | 'typealias' ID tpars? '=' type | mods 'constructor' '(' params? ')' (':' ('this' | 'super') '(' args? ')')? block? | 'init' block
acc = ';'? mods ID '(' ID? (':' type)? ')' (':' type)? fbody
where = 'where' ID ':' type (',' ID ':' type)*
fbody = block | '=' e
tpars = '<' mods ('in' | MOD)? ID (':' type)? (',' ('in' | MOD)? ID (':' type)?)* '>'
supers = super (',' super)*
super = type ('(' args? ')')? ('by' e)?
cbody = '{' (ents ';'?)? list '}'
ents = ent (',' ent)* ','?
ent = ID ('(' args? ')')? cbody?
cparams = cparam (',' cparam)* ','?
cparam = mods ('val' | 'var')? ID ':' type ('=' e)?
params = param (',' param)* ','?
param = mods ID ':' type ('=' e)?
file = ('#' '!')? (annot ';')* ('package' ID ('.' ID)* ';'?)? ('import' ID ('.' (ID | '*'))* ('as' ID)? ';')* list
"""
KOTLIN_WORDS = "package import fun val var class interface object if else when for while do try catch finally return throw break continue this super in is as by where typealias constructor init"
KOTLIN_GROUPS = {"BIN": "/ % || == != === !== <= >=", "ASG": "+= -= *= /= %=", "STEP": "++ --", "LIT": "true false null", "MOD": "public private protected internal abstract open final override lateinit const inline suspend data enum sealed companion out vararg operator infix tailrec external annotation inner noinline crossinline reified value"}
KOTLIN_SIGNS = "( ) [ ] { } ; , : :: = * + - < > -> . ?. ?: ? ! !! .. ..< @ && || / % == != === !== <= >= += -= *= /= %= ++ -- # !in !is"
BRACE_OPENERS = {".", "?.", "?:", "BIN", "&&", ")", "]", "}", ",", "else", "catch", "finally", ":", "=", "->", ";", "as", "by", "where", "ASG"}
KOTLIN_ENDERS = {"ID", "NUM", "STR", "CHR", "LIT", ")", "]", "}", "this", "super", "return", "break", "continue", "STEP", "?", "!!", "class", ">", "*"}

SWIFT_GRAMMAR = """
e = (TRY ('?' | '!')?)? u (infix u)* ('?' e ':' e)?
infix = BIN | '-' | '+' | '*' | '&' | '=' | ASG | '<' | '>' | '??' | RANGE | 'is' | 'as' ('?' | '!')?
u = '!' u | '-' u | '+' u | '&' u | RANGE u | TRY ('?' | '!')? u | 'await' u | p
p = prim tail*
prim = ID targs? | NUM | STR | LIT | 'self' | 'super' | 'Self' | '(' (arg (',' arg)*)? ')' | '[' (arg (',' arg)* ','?)? ']' | '[' ':' ']' | closure | '.' (ID | 'init') | DOLLAR | 'if' cond block 'else' (block | prim) | 'switch' e '{' case* '}'
arg = (lab ':')? (e | BIN | '<' | '>' | '+' | '*' | '-') | e ':' e
lab = ID | 'in' | 'for' | 'if' | 'is' | 'as' | 'where' | 'self' | 'default' | 'repeat' | 'while' | '_'
closure = '{' (('[' (ID? ID | ID 'self' | 'self') (',' ID? ID)* ']')? ((ID | '_') (',' (ID | '_'))* | '(' params? ')')? 'throws'? ('->' type)? 'in')? list '}'
tail = '(' (arg (',' arg)* ','?)? ')' | '[' (arg (',' arg)*)? ']' | '.' (ID | NUM | 'self' | 'init' | 'default') targs? | '?' '.' ID | '?' | '!' | closure | RANGE
targs = '<' type (',' type)* '>'
type = attr* ('inout' | 'some' | 'any' | 'some')? tp ('&' tp)* ('?' | '!')* (('async' | 'throws')* '->' type)?
tp = (ID | 'Self') targs? ('.' ID targs?)* | '[' type (':' type)? ']' | '(' (targ (',' targ)*)? ')'
targ = ((ID | '_') ID? ':')? type RANGE?
attr = '@' ID ('(' (arg (',' arg)*)? ')')?
mods = (attr | MOD ('(' ID ')')?)*
block = '{' list '}'
list = s? (';' s?)*
cond = c (',' c)*
c = e | ('let' | 'var') pat (':' type)? ('=' e)? | 'case' pats '=' e
pat = ID | '_' | '(' pat (',' pat)* ')'
pats = ('let' | 'var')? e | 'is' type | '.' ID ('(' (lab ':')? ('let' | 'var')? e (',' ('let' | 'var')? e)* ')')?
s = e | decl | ifs | 'guard' cond 'else' block | (ID ':')? ('for' 'case'? ('let' | 'var')? pat (':' type)? 'in' e ('where' e)? block | 'while' cond block | 'repeat' block 'while' e | 'switch' e '{' case* '}') | 'do' block ('catch' pats? ('where' e)? block)* | 'return' e? | 'throw' e | ('break' | 'continue') ID? | 'fallthrough' | 'defer' block
ifs = 'if' cond block ('else' (ifs | block))?
case = ('case' pats ('where' e)? (',' pats ('where' e)?)* | '@'? ID? 'default') ':' list
decl = 'import' ID? ID ('.' ID)* | mods ('let' | 'var') binding (',' binding)* | mods 'func' (ID | BIN | '<' | '>' | '+' | '-' | '*') tpars? '(' params? ')' ('async' | 'throws')* ('->' type)? where? block? | mods 'init' ('?' | '!')? tpars? '(' params? ')' 'throws'? where? block? | 'deinit' block | mods ('class' | 'struct' | 'protocol' | 'extension' | 'actor' | 'enum') ID ('.' ID)* tpars? (':' type (',' type)*)? where? '{' members '}' | mods ('typealias' | 'associatedtype') ID tpars? (':' type)? ('=' type)? where? | mods 'subscript' '(' params ')' '->' type block | 'case' ID ('(' targ (',' targ)* ')' | '=' e)? (',' ID ('(' targ (',' targ)* ')' | '=' e)?)*
members = list
binding = pat (':' type)? ('=' e)? accs?
accs = '{' list '}'
tpars = '<' ID (':' type)? (',' ID (':' type)?)* '>'
where = 'where' type (':' | BIN) type (',' type (':' | BIN) type)*
params = param (',' param)*
param = attr* (lab ID? | ID) ':' type RANGE? ('=' e)?
file = list
"""
SWIFT_WORDS = "import let var func init deinit class struct protocol extension actor enum typealias associatedtype subscript if else guard for in while repeat switch case default do catch return throw break continue fallthrough defer where is as self super Self await async throws inout some any _"
SWIFT_GROUPS = {"BIN": "/ % | ^ || && == != === !== <= >= << >> ~=", "ASG": "+= -= *= /= %= &= |= ^=", "RANGE": "... ..<", "LIT": "true false nil", "TRY": "try", "MOD": "public private fileprivate internal open static final override mutating lazy weak unowned required convenience indirect optional nonisolated", "throws": "rethrows"}
SWIFT_SIGNS = "( ) [ ] { } ; , : = * & + - < > -> . ?? ? ! @ / % | ^ || && == != === !== <= >= << >> ~= += -= *= /= %= &= |= ^= ... ..<"
SWIFT_ENDERS = {"ID", "NUM", "STR", "LIT", ")", "]", "}", "self", "super", "Self", "return", "break", "continue", "fallthrough", "?", "!", ">", "DOLLAR", "_"}

SCALA_GRAMMAR = """
e = (pars | ID | '_') '=>' (e | list) | u (infix ';'? u)* | u (infix u)* infix (ID | pars) '=>' e | 'if' '(' e ')' ';'? e (';'? 'else' e)? | 'while' '(' e ')' e | 'for' ('(' gens ')' | '{' gens '}') ';'? 'yield'? e | 'try' e ('catch' e)? ('finally' e)? | 'throw' e | 'return' e?
pars = '(' (par1 (',' par1)*)? ')'
par1 = (ID | '_') (':' type)?
infix = OP | '-' | '+' | '*' | '=' | '<' | '>' | ID | ':' | '<-'
u = ('-' | '+' | '!' | '~') u | p
p = prim tail*
prim = ID | '_' | NUM | STR | CHR | LIT | 'this' | 'super' | '(' (arg (',' arg)* ','?)? ')' | block | 'new' type tmpl | 'new' tmpl
arg = e (':' '_' '*')? | ID '=' e
tail = '(' (arg (',' arg)* ','?)? ')' | '.' (ID | 'type' | 'this') | targs | block | 'match' '{' cases '}' | '_' | ':' type
targs = '[' type (',' type)* ']'
block = '{' (cases | list) '}' | '{' (pars | ID | MOD ID | '_') '=>' list '}'
cases = ';'? ('case' pat ('if' e)? '=>' list)+
pat = pat1 ('|' pat1)*
pat1 = ID '@' pat2 | (ID | '_') ':' type | pat2
pat2 = p2 (ID p2 | OP p2 | OP p2)*
p2 = '_' '*'? | NUM | '-' NUM | STR | CHR | LIT | ID ('.' ID)* ('(' (pat (',' pat)*)? ')')? | '(' (pat (',' pat)*)? ')'
gens = gen (';' gen)* ';'?
gen = pat '<-' e | pat '=' e | 'if' e | pat '<-' e ('if' e)+
type = ty ('=>' type)?
ty = st ((ID | OP | 'with') st)*
st = (ID ('.' (ID | 'type'))* | '(' (type (',' type)*)? ')' | '_') ('[' type (',' type)* ']')* ('<:' type)? ('>:' type)? '*'? ('#' ID)? refine?
refine = '{' list '}'
annot = '@' ID ('(' (arg (',' arg)*)? ')')?
mods = (annot ';'? | MOD ('[' ID ']')?)*
list = s? (';' s?)*
s = e | decl | import
import = 'import' ID ('.' (ID | '_' | '*' | '{' (isel (',' isel)* ','?) '}' | 'this'))* (',' ID ('.' (ID | '_' | '{' isel (',' isel)* '}'))*)*
isel = (ID | '_') ('=>' (ID | '_'))?
decl = mods ('val' | 'var') pat (',' pat)* (':' type)? ('=' e)? | mods 'def' (ID | OP | 'this' | '+' | '-' | '*' | '<' | '>') tpars? params* (':' type)? ('=' e | block)? | mods 'type' ID tpars? ('>:' type)? ('<:' type)? ('=' type)? | mods 'case'? ('class' | 'object' | 'trait') ID tpars? (mods params)* tmpl
tmpl = (('extends' | 'with') type ('(' (arg (',' arg)*)? ')')* ('with' type)*)? ('{' (ID ':' type '=>' | ID '=>')? list '}')?
tpars = '[' tpar (',' tpar)* ']'
tpar = ('+' | '-')? (ID | '_') tpars? ('>:' type)? ('<:' type)? (':' type)*
params = '(' (MOD? param (',' param)* ','?)? ')'
param = mods ('val' | 'var')? ID ':' ('=>' )? type '*'? ('=' e)?
file = (';'? 'package' ID ('.' ID)* (';' | '{' list '}'))* list
"""
SCALA_WORDS = "package import val var def type class object trait case extends with if else while for yield try catch finally throw return new this super match _"
SCALA_GROUPS = {"LIT": "true false null", "MOD": "private protected override final sealed abstract implicit lazy inline", "OP": "/ % || && == != <= >= :: ++ -- += -= *= /= %= ::: -> & ^ ++= === :+ +: ?"}
SCALA_SIGNS = "( ) [ ] { } ; , : = * + - < > => <- . | @ # <: >: ! ~ " + SCALA_GROUPS["OP"]
SCALA_ENDERS = {"ID", "NUM", "STR", "CHR", "LIT", ")", "]", "}", "this", "super", "return", "_", "type"}
SCALA_OPENERS = {".", ")", "]", "}", ",", "else", "catch", "finally", ":", "=", "=>", ";", "extends", "with", "yield", "match", "OP", "{"}

RUBY_GRAMMAR = """
list = ';'* (s (';'+ s)* ';'*)?
s = e mod* | 'alias' (ID | SYM) (ID | SYM) | 'undef' ID
mod = ('if' | 'unless' | 'while' | 'until') e | 'rescue' e
e = 'not'? a (('and' | 'or') ';'* 'not'? a)*
a = '!' a | lhs (',' lhs)* ','? ('=' | ASG) rhs | t | ret
lhs = '*'? p | '(' lhs (',' lhs)* ')'
rhs = '*'? a (',' '*'? a)*
ret = ('return' | 'break' | 'next' | 'yield' | 'redo' | 'retry') (rhs)?
t = u (infix ';'* u)* ('?' a ':' a)?
infix = BIN | '<<' | '-' | '+' | '*' | '**' | '&' | '<' | '>' | RANGE | '|' | '::'
u = '!' u | '-' u | '+' u | '&' u | '~' u | 'defined?' u | RANGE u? | p
p = prim tail*
prim = ID | VAR | NUM | STR+ | SYM | REGEX | WORDS | LIT | 'self' | 'super' | 'yield' | '(' list ')' | '[' elems? ']' | '{' pairs? '}' | '->' lpars? (brace | 'do' list rescues 'end') | ctl | ID cargs | 'super' cargs | 'yield' cargs | '::' ID
cargs = carg (',' ';'* carg)*
carg = '*' u | '**' u | '&' u | SYM '=>' a | LABEL a? | a ('=>' a)? | STR ':' a
tail = '(' (carg (',' carg)* ','?)? ')' | '[' elems? ']' | ('.' | '&.') ';'* (ID | kw | '(' ) cargs? | '::' ID | brace | 'do' bpars? list rescues 'end'
kw = 'class' | 'then' | 'end' | 'begin' | 'next' | 'in' | 'if' | 'self' | 'alias' | 'and' | 'or' | 'not' | 'yield' | '+' | '-' | '*'
brace = '{' bpars? list '}'
bpars = '|' (bpar (',' bpar)*)? '|'
bpar = ('*' | '**' | '&')? ID ('=' u)? | '(' bpar (',' bpar)* ')' | LABEL u? | ';' ID
lpars = '(' (par (',' par)*)? ')' | par (',' par)*
elems = carg (',' carg)* ','?
pairs = pair (',' pair)* ','?
pair = LABEL a? | a '=>' a | '**' u | STR ':' a
then = ('then' | ';' 'then'?)
ctl = 'if' e then list ('elsif' e then list)* ('else' list)? 'end' | 'unless' e then list ('else' list)? 'end' | ('while' | 'until') e ('do' | ';') list 'end' | 'for' lhs (',' lhs)* 'in' e ('do' | ';') list 'end' | 'case' e? ';'* ('when' carg (',' carg)* then list | 'in' rhs then list)* ('else' list)? 'end' | 'begin' list rescues 'end' | def | 'class' ('<<' a | cpath ('<' a)?) ';' list rescues 'end' | 'module' cpath ';' list 'end' | 'BEGIN' brace | 'END' brace
cpath = '::'? ID ('::' ID)*
def = 'def' (('self' | ID) '.')? dname (dpars | ';' | par (',' par)* ';') list rescues 'end' | 'def' (('self' | ID) '.')? dname dpars? '=' a
dname = ID '='? | kw | BIN | '<' | '>' | '+' | '-' | '*' | '[' ']' '='? | '!' | '|' | '&' | '<<'
dpars = '(' (par (',' par)* ','?)? ')'
par = ('*' | '**' | '&')? ID ('=' a)? | LABEL a? | '*' | '**' | '&' | '(' par (',' par)* ')'
rescues = ('rescue' (rhs)? ('=>' p)? then list)* ('else' list)? ('ensure' list)?
file = list END?
"""
RUBY_WORDS = "def end class module if elsif else unless while until for in do case when then begin rescue ensure return break next redo retry yield self super and or not alias undef defined? BEGIN END"
RUBY_GROUPS = {"BIN": "/ % ^ || && == != === <= >= >> =~ !~ <=>", "ASG": "+= -= *= /= %= &= |= ^= <<= >>= **= ||= &&=", "LIT": "true false nil __FILE__ __LINE__ __method__", "RANGE": ".. ..."}
RUBY_SIGNS = "( ) [ ] { } ; , : :: ? = * ** & + - < > << => -> . &. | ! ~ " + RUBY_GROUPS["BIN"] + " " + RUBY_GROUPS["ASG"] + " .. ..."
RUBY_ENDERS = {"ID", "VAR", "NUM", "STR", "SYM", "REGEX", "WORDS", "LIT", ")", "]", "}", "self", "super", "return", "break", "next", "redo", "retry", "yield", "end", "then", "else", "begin", "do", "ensure", "rescue", "LABEL", "|", "?"}

DART_GRAMMAR = EXPRESSION + """
infix = BIN | '-' | '+' | '*' | '&' | '=' | ASG | '<' | '>' | '>' '>' | '>' '=' | '??' | 'is' '!'? | 'as'
u = PRE u | '-' u | '!' u | STEP u | 'await' u | 'throw' u | p
tail = targs? '(' args? ')' | '[' e ']' | ('.' | '?.' | CASC) (ID | 'new') | CASC '[' e ']' | '?' '[' e ']' | STEP | '!'
prim = ID targs? | 'this' | 'super' | NUM | STR+ | LIT | SYM | '(' (e (',' e)* ','?)? ')' | '(' params ')' async? ('=>' e | block) | '(' ')' async? ('=>' e | block) | 'const'? targs? '[' (el (',' el)* ','?)? ']' | 'const'? targs? '{' (el (',' el)* ','?)? '}' | ('new' | 'const') type ('.' ID)? '(' args? ')' | 'switch' '(' e ')' '{' (e ('when' e)? '=>' e (',' e '=>' e)* ','?)? '}'
el = ('...' '?'?)? e (':' e)? | 'if' '(' e ')' el ('else' el)? | 'await'? 'for' '(' forhead ')' el
async = ('async' | 'sync') '*'?
args = arg (',' arg)* ','?
arg = (ID ':')? e
targs = '<' type (',' type)* '>'
type = (ID | VOID) ('.' ID)? targs? '?'? | type0 'Function' targs? '(' tps? ')' '?'? | 'Function' targs? '(' tps? ')' '?'? | '(' type ID? (',' type ID?)* ','? ')'
type0 = (ID | VOID) ('.' ID)? targs? '?'?
tps = tp (',' tp)* ','?
tp = '[' tp (',' tp)* ','? ']' | '{' tp (',' tp)* ','? '}' | 'required'? type ID?
params = (param (',' param)* ','?) | (param (',' param)* ',')? ('[' param (',' param)* ','? ']' | '{' param (',' param)* ','? '}')
param = annot* ('required' | 'final' | 'covariant' | 'var' | 'const')* type? (('this' | 'super') '.')? ID ('(' params? ')')? '?'? (('=' | ':') e)?
annot = '@' ID ('.' ID)* ('(' args? ')')?
block = '{' s* '}'
vars = annot* ('late' | 'external' | 'static' | 'covariant' | CLASSMOD)* (('final' | 'const' | 'var') type? | type) ID ('=' e)? (',' ID ('=' e)?)*
s = block | ';' | e ';' | vars ';' | func | 'if' '(' e ('case' e)? ')' s ('else' s)? | 'while' '(' e ')' s | 'do' s 'while' '(' e ')' ';' | 'await'? 'for' '(' forhead ')' s | 'switch' '(' e ')' '{' (('case' e ('when' e)? | 'default') ':' s*)* '}' | 'return' e? ';' | 'break' ID? ';' | 'continue' ID? ';' | 'rethrow' ';' | 'try' block ((('on' type)? 'catch' '(' ID (',' ID)? ')' | 'on' type) block)* ('finally' block)? | 'assert' '(' args ')' ';' | 'yield' '*'? e ';' | ID ':' s
forhead = (vars | es)? ';' e? ';' es? | (('final' | 'const' | 'var') type? | type)? ID 'in' e
func = annot* ('external' | 'static')* type? ('get' | 'set')? ID tpars? '(' params? ')' fbody | annot* ('external' | 'static')* type? 'get' ID fbody
fbody = async? (block | '=>' e ';') | ';'
tpars = '<' ID ('extends' type)? (',' ID ('extends' type)?)* '>'
class = annot* CLASSMOD* ('class' | 'mixin' 'class'?) ID tpars? ('extends' type)? ('with' type (',' type)*)? ('on' type (',' type)*)? ('implements' type (',' type)*)? '{' member* '}' | annot* CLASSMOD* CLASSMOD* 'class' ID tpars? '=' type 'with' type (',' type)* ';' | annot* 'enum' ID tpars? ('with' type (',' type)*)? ('implements' type (',' type)*)? '{' (annot* ID targs? ('(' args? ')')? (',' annot* ID targs? ('(' args? ')')?)* ','?) (';' member*)? '}' | annot* 'extension' ID? tpars? 'on' type '{' member* '}' | annot* 'typedef' (type? ID tpars? '(' params? ')' | ID tpars? '=' type) ';'
member = vars ';' | func | annot* ('external' | 'static')* type? 'operator' (BIN | '<' | '>' | '+' | '-' | '*' | '&' | '[' ']' '='? | PRE) '(' params? ')' fbody | annot* ('external' | 'const' | 'factory')* ID ('.' (ID | 'new'))? '(' params? ')' (':' cinit (',' cinit)*)? (fbody | '=' type ('.' ID)? ';')
cinit = ('this' '.')? ID '=' e | ('this' | 'super') ('.' ID)? '(' args? ')' | 'assert' '(' args ')'
dir = annot* ('import' | 'export') STR ('if' '(' e ')' STR)? ('deferred'? 'as' ID)? (('show' | 'hide') ID (',' ID)*)* ';' | 'library' (ID ('.' ID)*)? ';' | 'part' ('of')? (STR | ID ('.' ID)*) ';'
file = dir* (class | func | vars ';' | ';')*
"""
DART_WORDS = "import export library part class mixin enum extension typedef extends with implements on if else while do for in switch case default return break continue rethrow try catch finally assert yield await async sync new const final var this super is as throw get set operator static external late required covariant factory show hide of deferred when Function"
DART_GROUPS = {"BIN": "/ % | ^ || && == != <= << ~/", "ASG": "+= -= *= /= %= &= |= ^= <<= ??= ~/=", "PRE": "~", "STEP": "++ --", "LIT": "true false null", "VOID": "void", "CLASSMOD": "abstract base sealed interface", "CASC": ".. ?.."}
DART_SIGNS = "( ) [ ] { } ; , : ? = * & + - < > => ?? ... . ?. ! @ .. ?.. / % | ^ || && == != <= << ~/ += -= *= /= %= &= |= ^= <<= ??= ~/= ~ ++ --"

PYTHON_GRAMMAR = """
file = (stmt | NEWLINE)*
stmt = simple NEWLINE | comp
simple = small (';' small)* ';'?
small = estmt | 'pass' | 'break' | 'continue' | 'return' tests? | 'raise' (test ('from' test)?)? | ('global' | 'nonlocal') ID (',' ID)* | 'del' tests | 'assert' test (',' test)? | 'import' dn (',' dn)* | 'from' ('.' | '...')* dotted? 'import' ('*' | '(' names ','? ')' | names) | 'type' ID tpars? '=' test
dn = dotted ('as' ID)?
dotted = id ('.' id)*
names = id ('as' id)? (',' id ('as' id)?)*
estmt = tests (ASG (tests | yield) | ':' test ('=' (tests | yield))? | ('=' (tests | yield))*) | yield
yield = 'yield' ('from' test | tests)?
tests = test1 (',' test1)* ','?
test1 = '*'? test
test = or ('if' or 'else' test)? | 'lambda' lpars? ':' test | id ':=' test
or = un (infix un)*
infix = BIN | '/' | '*' | '**' | '-' | '+' | 'in' | 'not' 'in' | 'is' 'not'? | '@'
un = ('not' | '-' | '+' | '~' | 'await') un | atom tail*
atom = id | NUM | STR+ | '...' | LIT | '(' (yield | tests | test1 cfor)? ')' | '[' (tests | test1 cfor)? ']' | '{' (dk (',' dk)* ','? | dk cfor)? '}'
dk = test ':' test | '**' or | test1
cfor = ('async'? 'for' targets 'in' or ('if' or | 'if' 'lambda' lpars? ':' test)*)+
targets = tgt (',' tgt)* ','?
tgt = '*'? (atom | id) tail*
tail = '(' (arg (',' arg)* ','?)? ')' | '[' sub (',' sub)* ','? ']' | '.' id
arg = test cfor? | id '=' test | '*' test | '**' test
sub = test1 | test? ':' test? (':' test?)?
lpars = lp (',' lp)* ','?
lp = ('*' | '**')? id ('=' test)? | '*' | '/'
id = ID | 'match' | 'case' | 'type'
block = simple NEWLINE | NEWLINE INDENT stmt+ DEDENT
comp = 'if' test ':' block ('elif' test ':' block)* ('else' ':' block)? | 'while' test ':' block ('else' ':' block)? | 'async'? 'for' targets 'in' tests ':' block ('else' ':' block)? | 'try' ':' block (('except' '*'? (tests ('as' ID)?)? ':' block)+ ('else' ':' block)? ('finally' ':' block)? | 'finally' ':' block) | 'async'? 'with' (wi (',' wi)* | '(' wi (',' wi)* ','? ')') ':' block | deco* 'async'? 'def' id tpars? '(' params? ')' ('->' test)? ':' block | deco* 'class' id tpars? ('(' (arg (',' arg)* ','?)? ')')? ':' block | 'match' tests ':' NEWLINE INDENT ('case' pats ('if' test)? ':' block)+ DEDENT
pats = pat (',' pat)* ','?
pat = '*'? or1 ('as' ID)?
or1 = or
wi = test ('as' tgt)?
deco = '@' test NEWLINE
tpars = '[' tests ']'
params = par (',' par)* ','?
par = ('*' | '**')? id (':' test)? ('=' test)? | '*' | '/'
"""
PYTHON_WORDS = "pass break continue return raise from global nonlocal del assert import as yield lambda if elif else for in not is and or while try except finally with def class async await match case type"
PYTHON_GROUPS = {"BIN": "% // | ^ & << >> < > == != <= >= and or", "ASG": "+= -= *= /= //= %= &= |= ^= <<= >>= **= @=", "LIT": "True False None"}
PYTHON_SIGNS = "( ) [ ] { } ; , : := = * ** + - / @ -> . ... ~ % // | ^ & << >> < > == != <= >= += -= *= /= //= %= &= |= ^= <<= >>= **= @="

JSON_GRAMMAR = """
file = v
v = '{' (STR ':' v (',' STR ':' v)*)? '}' | '[' (v (',' v)*)? ']' | STR | NUM | LIT
"""

SHELL_GRAMMAR = """
file = list
list = SEP* (line (SEP+ line)* SEP*)?
line = pipe (('&&' | '||' | '|' | '&') SEP* pipe)* '&'?
pipe = '!'? cmd
cmd = (W | redir | 'in')+ ( '(' ')' SEP* body)? | body redir* | 'function' W ('(' ')')? SEP* body
redir = REDIR (W | redir)
body = '{' list '}' | '(' list ')' | 'if' list 'then' list ('elif' list 'then' list)* ('else' list)? 'fi' | ('while' | 'until') list 'do' list 'done' | 'for' (W ('in' (W | 'in')*)? SEP* | ARITH SEP*) 'do' list 'done' | 'case' W 'in' SEP* ('('? W ('|' W)* ')' list (DSEMI SEP*)?)* 'esac' | ARITH
"""
YAML_GRAMMAR = """
file = (DIR* DOC)? doc (DOC doc | END+ (DIR* DOC doc)?)*
doc = (PROPS NL)? node?
node = map | seq | leaf
map = entry+
entry = PROPS? KEY value
value = PROPS? NL (INDENT node DEDENT | item+)? | PROPS? leaf
seq = item+
item = DASH (INDENT (map | seq) DEDENT | PROPS? NL (INDENT node DEDENT)? | PROPS? leaf)
leaf = (PROPS? SCALAR | PROPS? flow) NL CONT* | BLOCK NL
flow = '[' (fv (',' fv)* ','?)? ']' | '{' (fp (',' fp)* ','?)? '}'
fv = flow | W+ | fp
fp = (W+ | flow) ':' fv? | W+
"""

# Lexers of the languages whose tokens depend on their place


def _shell_kinds(language: Language, tokens: list[str], marks: list[int] | None = None) -> list[str]:
    """Words are keywords only where a command may begin."""
    out: list[str] = []
    begins, inside = True, []
    for t in tokens:
        if marks is not None:
            marks.append(len(out))
        c = t[0]
        if c == "\n":
            if out and out[-1] != "SEP":
                out.append("SEP")
            begins = True
            continue
        k = language.memory.get(t, 0)
        if k == 0:
            k = language.kind(t)
        if k is None:
            continue
        if k in language.words and k not in ("W", "in"):
            if not begins:
                k = "W"
        elif k == "in" and not (inside and out and out[-1] == "W"):
            k = "W"
        if k in ("for", "case", "function"):
            inside.append(k)
            begins = False
        elif k == "in":
            inside.pop()
            begins = True
        elif k in ("SEP", "DSEMI", "&&", "||", "|", "&", "(", ")", "{", "if", "then", "elif", "else", "while", "until", "do", "!"):
            begins = True
        elif k in ("}", "fi", "done", "esac"):
            begins = True
        else:
            begins = False
        if k == ";":
            k = "SEP"
            begins = True
        out.append(k)
    return out


class Yaml:
    """Block structure as INDENT and DEDENT, entries as KEY and DASH, flow collections sign by sign.

    The lexer follows indentation, quotes and block scalars; what may follow what is the grammar's.
    """

    line = re.compile(r"^( *)(.*)$")
    key = re.compile(r"""(?:"(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|[^\s#\-?:,\[\]{}&*!|>'"%@`][^#:\n]*?|[-?:][^\s#:][^#:\n]*?)\s*:(?=\s|$)|[?:](?=\s|$)""")
    props = re.compile(r"(?:[&!]\S*(?:\s+|$))+")
    block = re.compile(r"[|>][-+0-9]*\s*(?:#.*)?$")
    quoted = re.compile(r"""(?:"(?:[^"\\]|\\.)*"|'(?:[^']|'')*')(\s*(?:#.*)?)$""")
    comment = re.compile(r"\s#.*$")
    flow_finder = re.compile(r"""[\[\]{},]|:(?=\s|$|[\[{,}\]])|"(?:[^"\\]|\\.)*"|'(?:[^']|'')*'|(?:[^\s\[\]{},:"']|:(?![\s,\]}]|$))(?:[^\s\[\]{},:]|:(?![\s,\]}]|$))*|["']""")

    def __init__(self):
        self.grammar = Grammar(YAML_GRAMMAR)

    def check(self, text: str) -> tuple[str, int, str] | None:
        """None for a sentence; else ('failing' or 'truncated', its line from 1, the token)."""
        lines = text.removeprefix("﻿").replace("\r\n", "\n").replace("\r", "\n").split("\n")
        kinds, where = self.lex(lines)
        at = self.grammar.check(kinds)
        if at is None:
            return None
        return ("truncated", len(lines), "") if at >= len(kinds) else ("failing", *where[at])

    def lex(self, lines: list[str]) -> tuple[list[str], list[tuple[int, str]]]:
        """Kinds, and the line and text of each."""
        kinds: list[str] = []
        where: list[tuple[int, str]] = []
        levels: list[int] = []
        literal = None  # indentation above which a block scalar goes on
        plain = None  # indentation above which a plain scalar may go on
        quote, owner = "", 0  # a quoted scalar that is still open, and the indentation it must stay above
        nested, tail = 0, ""  # open brackets of a flow collection, a quoted part still open in it

        def put(kind: str, n: int, token: str) -> None:
            kinds.append(kind)
            where.append((n, token[:80]))

        def flow(body: str, n: int) -> None:
            nonlocal nested, tail
            body, tail = self.comment.sub("", tail + body), ""
            for m in self.flow_finder.finditer(body):
                t = m.group()
                if t in ("\"", "'"):
                    tail = body[m.start() :] + " "
                    return
                nested += (t in "[{") - (t in "]}")
                put(t if t in "[]{},:" else "W", n, t)
            if nested <= 0:
                put("NL", n, "\n")

        def close(n: int) -> None:
            for _ in levels[1:]:
                put("DEDENT", n, lines[n - 1].strip() if n <= len(lines) else "")
            levels.clear()

        def scalar(value: str, own: int, n: int, deepest: int) -> None:
            """What stands behind a key, a dash or alone on a line."""
            nonlocal literal, plain, quote, owner, nested
            m = self.props.match(value)
            if m:
                put("PROPS", n, m.group().strip())
                value = value[m.end() :]
            if not value or value[0] == "#":
                put("NL", n, "\n")
            elif self.block.match(value):
                put("BLOCK", n, value)
                put("NL", n, "\n")
                literal = own
            elif value[0] in "\"'":
                m = self.quoted.match(value)
                if m:
                    put("SCALAR", n, value)
                    put("NL", n, "\n")
                elif re.match(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^']|'')*'(?!')", value):
                    put(ERROR, n, value)  # something stands behind the closing quote
                else:
                    quote, owner = value, own
            elif value[0] in "[{":
                nested = 0
                flow(value, n)
            elif value[0] in "@`%" or re.search(r":(?:\s|$)", self.comment.sub("", value)):
                put(ERROR, n, value)
            else:
                put("SCALAR", n, value)
                put("NL", n, "\n")
                plain = deepest

        for n, raw in enumerate(lines, 1):
            indent, body = self.line.match(raw).groups()
            body, depth = body.rstrip(), len(indent)
            if literal is not None:
                if not body or depth > literal:
                    continue
                literal = None
            if quote:
                if body and depth <= owner:
                    put(ERROR, n, body)
                    quote = ""
                    continue
                quote += " " + body
                if self.quoted.match(quote):
                    put("SCALAR", n, body)
                    put("NL", n, "\n")
                    quote = ""
                elif re.match(r"\"(?:[^\"\\]|\\.)*\"|'(?:[^']|'')*'(?!')", quote):
                    put(ERROR, n, body)
                    quote = ""
                continue
            if nested > 0:
                if body and (body[0] != "#" or tail):
                    flow(body, n)
                continue
            if not body or body[0] == "#":
                continue
            if body in ("---", "...") and not depth or raw.startswith("--- "):
                close(n)
                put("END" if body == "..." else "DOC", n, body[:3])
                plain = None
                if body[3:].strip() and body[3:].strip()[0] != "#":
                    scalar(body[3:].strip(), -1, n, -1)
                continue
            if body[0] == "%" and not levels and (not kinds or kinds[-1] in ("DIR", "END")):
                put("DIR", n, body)
                continue
            if body[0] == "\t":
                put(ERROR, n, "\t")
                continue
            held = self.props.match(body)
            shaped = body == "-" or body.startswith("- ") or self.key.match(body, held.end() if held else 0)
            if not shaped and plain is not None and depth > plain:
                put(ERROR if re.search(r":(?:\s|$)", self.comment.sub("", body)) else "CONT", n, body)
                continue
            plain = None
            if not levels:
                levels.append(depth)
            elif depth > levels[-1]:
                levels.append(depth)
                put("INDENT", n, body)
            else:
                while len(levels) > 1 and depth < levels[-1]:
                    levels.pop()
                    put("DEDENT", n, body)
                if depth != levels[-1]:
                    put(ERROR, n, body)
            value, column = body, depth
            while value == "-" or value.startswith("- "):
                put("DASH", n, "-")
                rest = value[1:].lstrip()
                inner = column + len(value) - len(rest)
                held = self.props.match(rest)
                value = rest
                if not (rest == "-" or rest.startswith("- ") or self.key.match(rest, held.end() if held else 0)):
                    break
                levels.append(inner)
                put("INDENT", n, rest)
                column = inner
            held = self.props.match(value)
            m = self.key.match(value, held.end() if held else 0)
            if m:
                if held:
                    put("PROPS", n, held.group().strip())
                put("KEY", n, m.group())
                value = value[m.end() :].strip()
            scalar(value, column, n, column if shaped else depth - 1)
        if not quote and nested <= 0:
            close(len(lines) + 1)
        return kinds, where


def _c(grammar: str, words: str, groups: dict[str, str], signs: str = C_SIGNS, strings: list[str] | None = None) -> Language:
    return Language(grammar, words, signs, [*SLASH, DIRECTIVE, r"\\\n"], strings or [r"(?:u8|[uUL])?" + QUOTED], groups=groups, before=[("CHR", r"[uUL]?" + CHR)])


@cache
def language(name: str):
    """The checker of a language by its label in lower case; None where there is none."""
    if name == "c":
        return _c(C_GRAMMAR, "if else while do for switch case default return break continue goto struct union enum typedef sizeof", C_GROUPS)
    if name in ("c++", "cpp"):
        groups = C_GROUPS | {"CV": "const volatile", "MOD": "static extern inline register auto mutable explicit virtual thread_local", "LIT": "true false nullptr", "CAST": "static_cast dynamic_cast const_cast reinterpret_cast", "BIN": C_GROUPS["BIN"] + " <=>", ".": "."}
        groups["BIN"] = groups["BIN"].replace("&& ", "")
        words = "if else while do for switch case default return break continue goto struct union enum class typedef sizeof new delete throw try catch this template typename namespace using public private protected friend operator constexpr noexcept override final decltype static_assert co_await"
        return _c(CPP_GRAMMAR, words, groups, C_SIGNS + " :: <=>", [r'R"\((?:[^)]|\)(?!"))*\)"', r"(?:u8|[uUL])?" + QUOTED])
    if name == "java":
        return Language(JAVA_GRAMMAR, JAVA_WORDS, JAVA_SIGNS, SLASH, [TEXT_BLOCK, QUOTED], groups=JAVA_GROUPS, before=[("CHR", CHR)], name=r"[^\W\d][\w$]*|\$[\w$]+")
    if name in ("c#", "csharp"):
        skip = [*SLASH, r"(?<![^\n])[ \t]*\#[ \t]*(?:region|endregion|if|else|elif|endif|define|undef|pragma|nullable|warning|error)\b[^\n]*"]
        return Language(CS_GRAMMAR, CS_WORDS, CS_SIGNS, skip, [r'(?:\$@|@\$|@)"(?:[^"]|"")*"', TEXT_BLOCK, r"\$?" + QUOTED], groups=CS_GROUPS, before=[("CHR", CHR)], name=r"@?[^\W\d]\w*")
    if name == "go":
        return Language(GO_GRAMMAR, GO_WORDS, GO_SIGNS, SLASH, [QUOTED, r"`[^`]*`"], groups=GO_GROUPS, before=[("CHR", CHR)], layout=semicolons({"ID", "NUM", "STR", "CHR", "BRK", "return", "STEP", ")", "]", "}"}, set(), in_brackets=False))
    if name in ("javascript", "js"):
        made = Language(JS_GRAMMAR, JS_WORDS, JS_SIGNS, [*SLASH, r"\A\#![^\n]*"], [QUOTED, SINGLE, TEMPLATE], groups=JS_GROUPS, before=[("REGEX", REGEX)], tell={"REGEX": REGEX_ALONE}, name=r"[^\W\d][\w$]*|[$\#@]?[\w$]+(?<!\d)|\$", layout=semicolons(JS_ENDERS, JS_OPENERS))
        return made
    if name in ("typescript", "ts"):
        return Language(TS_GRAMMAR, TS_WORDS, JS_SIGNS + " @ | &", [*SLASH, r"\A\#![^\n]*"], [QUOTED, SINGLE, TEMPLATE], groups=TS_GROUPS | {"BIN": TS_GROUPS["BIN"].replace(" | ", " ")}, before=[("REGEX", REGEX)], tell={"REGEX": REGEX_ALONE}, name=r"[^\W\d][\w$]*|\$[\w$]*|\#\w+", layout=semicolons(JS_ENDERS | {">", "?"}, JS_OPENERS))
    if name == "php":
        return Language(PHP_GRAMMAR, PHP_WORDS, PHP_SIGNS, [r"//(?:(?!\?>)[^\n])*", r"\#(?!\[)(?:(?!\?>)[^\n])*", SLASH[1]], [r'"(?:[^"\\]|\\[\s\S])*"', r"'(?:[^'\\]|\\[\s\S])*'", r"`(?:[^`\\]|\\.)*`"], groups=PHP_GROUPS, before=[("OPEN", r"<\?(?:php\b|=)"), ("CLOSE", r"\?>(?:(?!<\?(?:php\b|=))[\s\S])*"), ("CASTS", r"\((?:int|integer|float|double|string|bool|boolean|array|object)\)"), ("VAR", r"\$+[^\W\d]\w*")])
    if name == "rust":
        return Language(RUST_GRAMMAR, RUST_WORDS, RUST_SIGNS, SLASH, [r'b?r"[^"]*"', r'b?r\#"(?:[^"]|"(?!\#))*"\#', r'b?"(?:[^"\\]|\\[\s\S])*"'], groups=RUST_GROUPS, before=[("CHR", r"b?'(?:[^'\\\n]|\\(?:u\{\w+\}|x\w\w|.))'"), ("LIFE", r"'[^\W\d]\w*")], number=r"\d[\w]*(?:\.\d[\w]*)?(?:(?<=[eE])[+-]\d+)?")
    if name == "kotlin":
        return Language(KOTLIN_GRAMMAR, KOTLIN_WORDS, KOTLIN_SIGNS, SLASH, [TEXT_BLOCK, QUOTED], groups=KOTLIN_GROUPS, before=[("CHR", CHR)], number=r"\d\w*(?:\.\d\w*)?", name=r"[^\W\d]\w*|`[^`\n]+`", layout=semicolons(KOTLIN_ENDERS, BRACE_OPENERS))
    if name == "swift":
        return Language(SWIFT_GRAMMAR, SWIFT_WORDS, SWIFT_SIGNS, [*SLASH, r"(?<![^\n])[ \t]*\#(?:if|else|elseif|endif)\b[^\n]*"], [TEXT_BLOCK, QUOTED], groups=SWIFT_GROUPS, before=[("DOLLAR", r"\$\w+")], number=r"\d\w*(?:\.\d\w*)?", name=r"[^\W\d]\w*|`\w+`|\#\w+", layout=semicolons(SWIFT_ENDERS, BRACE_OPENERS | {"??", "where"}))
    if name == "scala":
        return Language(SCALA_GRAMMAR, SCALA_WORDS, SCALA_SIGNS, SLASH, [r"\w*" + TEXT_BLOCK, r"(?:[^\W\d]\w*)?" + QUOTED], groups=SCALA_GROUPS, before=[("CHR", CHR)], number=r"\d\w*(?:\.\d\w*)?", name=r"[^\W\d][\w$]*|`[^`\n]+`|'[^\W\d]\w*", layout=semicolons(SCALA_ENDERS, SCALA_OPENERS - {"{"}))
    if name == "ruby":
        skip = [r"(?<![^\n])=begin\b[\s\S]*?\n=end\b[^\n]*", r"\#[^\n]*", r"\\\n"]
        before = [("WORDS", r"%[wWiIqQ]?(?:\((?:[^()\\]|\\.)*\)|\[(?:[^\[\]\\]|\\.)*\]|\{(?:[^{}\\]|\\.)*\})"), ("REGEX", r"(?<=[=(,~\[!&|?{;\n])[ ]?/(?![*/\s=])(?:[^/\\\n]|\\.)+/[a-z]*"), ("LABEL", r"(?:[^\W\d]\w*[?!]?):(?=[\s,)\]}])"), ("SYM", r':(?:[^\W\d]\w*[?!=]?(?![=>])|"(?:[^"\\]|\\.)*"|\[\]=?|[+\-*/<>]=?|==)'), ("VAR", r"@{1,2}[^\W\d]\w*|\$[\w!@&~0-9]+"), ("ID", r"(?<=def )[^\W\d]\w*[?!=]?(?=[\s(;])|(?<=self\.)[^\W\d]\w*[?!](?!=)|[^\W\d]\w*[?!](?![=:])")]
        tell = {"REGEX": REGEX_ALONE, "LABEL": r"[^\W\d]\w*[?!]?:", "SYM": r':(?:[^\W\d]\w*[?!=]?|"(?:[^"\\]|\\.)*"|\[\]=?|[+\-*/<>]=?|==)', "ID": r"[^\W\d]\w*[?!=]?"}
        return Language(RUBY_GRAMMAR, RUBY_WORDS, RUBY_SIGNS, skip, [r'"(?:[^"\\]|\\[\s\S])*"', r"'(?:[^'\\]|\\[\s\S])*'", r"`(?:[^`\\]|\\.)*`"], groups=RUBY_GROUPS, before=before, tell=tell, number=r"\d\w*(?:\.\d\w*)?", layout=semicolons(RUBY_ENDERS, {".", "&.", ")", "]", ";"} , in_brackets=True))
    if name == "dart":
        return Language(DART_GRAMMAR, DART_WORDS, DART_SIGNS, SLASH, [r'r?"""(?:[^"\\]|\\[\s\S]|"(?!""))*"""', r"r?'''(?:[^'\\]|\\[\s\S]|'(?!''))*'''", "r?" + QUOTED, "r?" + SINGLE], groups=DART_GROUPS, before=[("SYM", r"\#[^\W\d]\w*")], number=r"\d\w*(?:\.\d\w*)?(?:(?<=[eE])[+-]\d+)?", name=r"[^\W\d][\w$]*|\$[\w$]*")
    if name == "python":
        prefix = r"(?:[rRbBfFuUtT]{1,2})?"
        strings = [prefix + r'"""(?:[^"\\]|\\[\s\S]|"(?!""))*"""', prefix + r"'''(?:[^'\\]|\\[\s\S]|'(?!''))*'''", prefix + r'(?:"(?:[^"\\\n]|\\[\s\S])*"(?!"))', prefix + r"(?:'(?:[^'\\\n]|\\[\s\S])*'(?!'))"]
        number = r"0[xX][0-9a-fA-F_]+|0[oO][0-7_]+|0[bB][01_]+|(?:\d[\d_]*(?:\.[\d_]*)?|\.\d[\d_]*)(?:[eE][+-]?\d[\d_]*)?[jJ]?"
        return Language(PYTHON_GRAMMAR, PYTHON_WORDS, PYTHON_SIGNS, [r"\#[^\n]*", r"\\\n"], strings, groups=PYTHON_GROUPS, number=number, layout=indents)
    if name == "json":
        return Language(JSON_GRAMMAR, "", "{ } [ ] , :", [], [r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*"'], before=[("LIT", r"(?:true|false|null)\b")], number=r"-?(?:0|[1-9]\d*)(?:\.\d+)?(?:[eE][+-]?\d+)?(?![\w.])", name=r"(?!)")
    if name in ("shell", "sh", "bash"):
        made = Language(SHELL_GRAMMAR, "if then elif else fi while until do done for case esac function in { } !", "( ) | & && || ;", [r"(?<!\S)\#[^\n]*", r"\\\n"], [], before=[("ARITH", r"\(\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\)\)"), ("DSEMI", r";;&?|;&"), ("REDIR", r"\d*(?:<<<|<<-?|>>|<&|>&|&>>?|<|>\|?)(?:\d|-)?"), ("W", r"""(?:\$\((?:[^()]|\((?:[^()]|\([^()]*\))*\))*\)|\$\{[^}]*\}|"(?:[^"\\]|\\[\s\S])*"|'[^']*'|`[^`]*`|\\.|=\((?:[^()]|"[^"]*")*\)|[^\s"'`\\()|&;<>])+""")], name=r"(?!)", number=r"(?!)", layout=_shell_kinds)
        return made
    if name in ("yaml", "yml"):
        return Yaml()
    return None
