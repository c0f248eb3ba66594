import ast

import pytest

from siltstone.llm import syntax
from siltstone.llm.derivatives import Grammar
from siltstone.llm.grammars import language

#: One text per language, accepted whole; the cut text ends early, the broken one fails at a token.
VALID = {
    "c": '#include <stdio.h>\nstruct p { int x; char *s; };\nstatic int f(int a, const char *b) {\n  for (int i = 0; i < a; i++) { if (b[i] == \'x\') continue; else a += (int) b[i]; }\n  return a ? f(a - 1, b) : 0;\n}\n',
    "c++": '#include <vector>\nnamespace n {\ntemplate <typename T> class Box : public Base<T> {\n public:\n  explicit Box(T v) : v_(v) {}\n  T get() const { return v_; }\n private:\n  T v_;\n};\n}\nint main() { std::vector<int> v{1, 2}; for (auto &x : v) std::cout << x << std::endl; auto f = [&](int y) { return y + 1; }; return f(1); }\n',
    "c#": 'using System;\nnamespace N {\n  public class A : B {\n    private readonly int[] xs = { 1, 2 };\n    public int P { get; set; } = 3;\n    public int M(int a, string b = "x") { foreach (var x in xs) { a += x; } return xs.Length > 0 ? a : -1; }\n  }\n}\n',
    "java": 'package a.b;\nimport java.util.*;\npublic final class A<T extends B> implements C {\n  @Override public <R> List<R> m(Map<String, R> x, int... y) throws E {\n    for (int i = 0; i < y.length; i++) { x.values().stream().map(v -> v).toList(); }\n    try { n(); } catch (E | F e) { throw e; } finally { done(); }\n    return new ArrayList<>(x.values());\n  }\n}\n',
    "javascript": "import a from './a.js'\nconst f = async (x, { y = 1, ...z }) => { await g(`t ${x}`); return x?.y ?? [1, ...z] }\nclass A extends B {\n  static #n = 1;\n  get v() { return /a[/]b/.test('q') }\n}\nfor (const k of [1, 2]) { if (k) f(k, {}); else continue }\nexport default A\n",
    "typescript": "interface P<T> { readonly a?: T; m(x: number): void }\ntype U = string | null;\nexport class A<T> implements P<T> {\n  constructor(private x: number, public a?: T) {}\n  m(x: number): void { const y = x as unknown as Map<string, number[]>; }\n}\nfunction g<T extends U>(v: T, ...r: T[]): v is T { return !!v; }\n",
    "go": 'package main\n\nimport (\n\t"fmt"\n)\n\ntype T struct {\n\ta, b int\n}\n\nfunc (t *T) F(x []int, m map[string]int) (int, error) {\n\tfor i, v := range x {\n\t\tif v > 0 && i != 2 {\n\t\t\tfmt.Println(v)\n\t\t}\n\t}\n\tgo func() { t.a++ }()\n\treturn len(x), nil\n}\n',
    "php": "<?php\nnamespace A\\B;\nuse C\\D as E;\nfinal class X extends Y {\n  private ?int $a = 1;\n  public function f(array $x, string ...$y): ?int { foreach ($x as $k => $v) { echo \"$k\" . $v; } return $this->a ?? self::Z; }\n}\nfunction g(int $n) { return fn($x) => $x + $n; }\n",
    "rust": "use std::{fmt, collections::HashMap};\n#[derive(Debug)]\npub struct A<'a, T: Clone> { x: &'a T, y: Vec<u8> }\nimpl<'a, T: Clone> A<'a, T> {\n    pub fn f(&mut self, n: i32) -> Result<i32, String> {\n        let mut m = HashMap::new();\n        for i in 0..n { m.insert(i, vec![1; 3]); }\n        match n { 0 | 1 => Ok(1), k if k > 5 => { println!(\"{}\", k); Err(\"x\".into()) } _ => Ok(m.len() as i32) }\n    }\n}\n",
    "kotlin": 'package a\nimport b.*\ndata class P(val x: Int, val y: String = "z")\nfun <T> f(xs: List<T>, g: (T) -> Int): Int {\n    var n = 0\n    for (x in xs) { n += g(x) }\n    val s = when (n) { 0 -> "a"\n        else -> "b" }\n    return xs.map { it.hashCode() }.sum() + n\n}\n',
    "swift": 'import Foundation\nstruct A: B {\n    let x: [Int]\n    var y: String? = nil\n    func f(_ a: Int, with b: Double) throws -> Int {\n        guard let z = y else { return a }\n        for i in 0..<a where i > 1 { print("\\(i)", z) }\n        return x.map { $0 + 1 }.reduce(0, +)\n    }\n}\n',
    "scala": "package a.b\nimport c.{D, E => F}\nobject A extends B with C {\n  case class P(x: Int, y: String = \"z\")\n  def f[T](xs: Seq[T])(g: T => Int): Int = {\n    val n = for (x <- xs if x != null) yield g(x)\n    n match {\n      case Nil => 0\n      case h :: _ => h\n    }\n  }\n}\n",
    "ruby": "require 'x'\nmodule A\n  class B < C\n    attr_reader :a, :b\n    def f(x, y = 1, *z, k: 2)\n      return nil unless x\n      x.each_with_index do |v, i|\n        puts \"#{v}\" if i > 0\n      end\n      @h = { a: 1, 'b' => 2 }\n    rescue E => e\n      raise\n    end\n  end\nend\n",
    "dart": "import 'dart:io';\nabstract class A<T> extends B with C implements D {\n  final int x;\n  A(this.x, {required this.y, int z = 1}) : w = x + 1, super();\n  Future<List<T>> f(Map<String, int> m) async {\n    for (var k in m.keys) { print('$k'); }\n    return [for (final v in await g()) v];\n  }\n}\n",
    "python": "import os, sys\nfrom . import a as b\n@deco(1)\nclass A(B, metaclass=C):\n    \"\"\"Doc.\"\"\"\n    x: int = 1\n    async def f(self, a, /, b=2, *args, c, **kw) -> int:\n        with open(a) as h, g():\n            return [y async for y in h if y] or {k: v for k, v in kw.items()}\n        lambda q: (q, *args)\n\ntry:\n    pass\nexcept (E, F) as e:\n    raise G from e\nelse:\n    x = y = 1; z += 2\n",
    "json": '{"a": [1, -2.5e3, true, null], "b": {"c": "\\u00e9\\n"}}\n',
    "shell": '#!/bin/sh\nset -eu\nX="a b" Y=1\nfor f in *.txt; do\n  if [ -f "$f" ] && grep -q x "$f"; then echo "$f" >> out; else cat <"$f" | wc -l; fi\ndone\nf() {\n  case "$1" in\n    a|b) echo yes ;;\n    *) return 1 ;;\n  esac\n}\nf "$@" || exit 2\n',
    "yaml": "# c\na: 1\nb:\n  - x: 'y'\n    z: [1, {q: 2}]\n  - |\n    free text: here\nd: \"s\" # end\n",
}
BROKEN = {
    "c": "int f(int a) { return a +; }", "c++": "int f() { std::cout << ; }", "c#": "class A { int f( { } }", "java": "class A { int f() { return 1 } }", "javascript": "function f( { return 1 }",
    "typescript": "const x: = 1;", "go": "package a\n\nfunc f() {\n\tx := \n}\n}", "php": "<?php $a = ; ", "rust": "fn f( -> i32 { 1 }", "kotlin": "fun f(: Int) {}", "swift": "func f(_ a Int) { }",
    "scala": "object A { def f(: Int = 1 }", "ruby": "def f(x\n  1\nend\nend", "dart": "int f() { return 1 + ; }", "python": "def f(x)\n    return x\n", "json": '{"a": 1,}', "shell": "if true; then echo; done", "yaml": "a: 1\n b: 2\n",
}


@pytest.mark.parametrize("name", VALID)
def test_valid_files_pass(name):
    assert syntax.verdict(name.upper() if name != "c#" else " C# ", VALID[name]) == ("valid", None, None)
    assert syntax.verdict(name, VALID[name].replace("\n", "\r\n"))[0] == "valid"


@pytest.mark.parametrize("name", BROKEN)
def test_broken_files_fail(name):
    kind, line, _ = syntax.verdict(name, BROKEN[name])
    assert kind in ("failing", "truncated") and line >= 1


@pytest.mark.parametrize("name", [n for n in VALID if n not in ("yaml", "shell")])
def test_conflict_marks_and_pages_fail(name):
    lines = VALID[name].split("\n")
    half = len(lines) // 2
    conflict = "\n".join([*lines[:half], "<<<<<<< HEAD", lines[half], "=======", lines[half], ">>>>>>> topic", *lines[half:]])
    assert syntax.verdict(name, conflict)[0] != "valid"
    if name != "php":
        assert syntax.verdict(name, "<!DOCTYPE html>\n<html>\n<body>gone</body>\n</html>\n")[0] != "valid"


@pytest.mark.parametrize("name", ["c", "java", "go", "rust", "python", "json"])
def test_truncation_is_told(name):
    text = VALID[name].rstrip()
    if name == "python":
        cut = text[: text.index("with open(a") + 10]
    else:
        cut = text[:-1] if name == "json" else text[: text.rindex("\n")].rstrip(" ,;")
    assert syntax.verdict(name, cut)[0] in ("truncated", "failing")
    assert syntax.verdict("json", '{"a": [1, 2')[0] == "truncated"


def test_failing_token_and_line():
    assert syntax.verdict("c", "int a;\nint b = 1 2;\n") == ("failing", 2, "2")


def test_python_agrees_with_its_own_parser():
    texts = ["x = (1,\n  2)\n", "if x:\n  y\n else:\n  z\n", "class A: pass\n", "def f(): return\n", "a = b = \n", "for x in y: pass\nelse: z\n", "x = '''a\n", "print(f'{x}')\n", "x = [i for i in y if z]\n", "@a.b\ndef f(): ...\n", "with a as b, c: pass\n", "lambda: 0\n", "x if y\n", "del x,\n", "a <> b\n", "1abc\n", "\tx\n", "if a:\n\tb\n", "not x is y\n"]
    for t in texts:
        try:
            ast.parse(t)
            ok = True
        except SyntaxError:
            ok = False
        assert (syntax.verdict("python", t)[0] == "valid") == ok, t


def test_engine():
    g = Grammar("file = ( 'a' file 'b' )? \n", "file")
    assert g.check(list("aabb")) is None and g.check(list("aab")) == 3 and g.check(list("ba")) == 0 and g.check([]) is None
    deep = ["a"] * 3000 + ["b"] * 3000
    assert g.check(deep) is None


def test_cases_without_a_verdict():
    assert syntax.verdict("python", None) == syntax.verdict("python", " \n") == ("blank", None, None)
    assert syntax.verdict(None, "x") == syntax.verdict("cobol", "x") == ("unsupported", None, None)
    assert syntax.verdict("python", "x = 1\n" * 50_000)[0] == "valid"
    assert language("python") is language("python")


def test_rates(spark):
    df = spark.createDataFrame([("a", "r", "python", "x = 1"), ("b", "r", "python", "x ="), ("c", None, None, None), ("b", "r", "python", "x =")], "document_id string, repo_id string, language string, content string")
    out = {r["repo_id"]: (r["n_files"], r["n_invalid"], r["invalid_share"]) for r in syntax.rates(syntax.check_files(df, ["document_id", "repo_id"]).distinct(), "repo_id").collect()}
    assert out == {"r": (2, 1, 0.5), None: (0, 0, None)}
    assert syntax.check_files(df.limit(0), ["document_id"]).count() == 0


@pytest.mark.parametrize("text", ["---\na: 1\n", "%YAML 1.2\n---\na: 1\n", "# c\n\n---\n- a\n- b\n---\nc: 2\n...\n", "---\n---\na: 1\n", "a: 1\n...\n%YAML 1.2\n---\nb: 2\n", "---\r\na: 1\r\n"])
def test_yaml_may_begin_with_a_document_mark(text):
    assert language("yaml").check(text) is None


@pytest.mark.parametrize("text", ["---\na: 'x\nb: 1\n", "---\na: [1, 2\n"])
def test_yaml_after_a_document_mark_is_checked(text):
    assert language("yaml").check(text) is not None


#: A faulty line per language; put behind a valid file it must be found there, with its token.
FAULTS = {
    "c": ("int f() { return 1 1; }", "1"), "c++": ("int f() { return 1 1; }", "1"), "c#": ("class Q { int f() { return 1 1; } }", "1"), "java": ("class Q { int f() { return 1 1; } }", "1"),
    "javascript": ("var q = 1 1", "1"), "typescript": ("let q = 1 1", "1"), "go": ("func q() int { return 1 1 }", "1"), "rust": ("fn q() { let a = 1 1; }", "1"), "kotlin": ("val q = 1 1", "1"), "swift": ("let q = 1 1", "1"),
    "scala": ("object Q { val q = ) 1 }", ")"), "ruby": ("x = 1 1", "1"), "dart": ("int q = 1 1;", "1"), "python": ("x = 1 1", "1"), "shell": ("if x; fi fi", "fi"), "php": ("$a = 1 1;", "1"), "yaml": ("a: 'b' c", "'b' c"),
}
REPEATABLE = {"c", "c++", "javascript", "typescript", "rust", "swift", "ruby", "python", "shell", "yaml"}


@pytest.mark.parametrize("name", FAULTS)
def test_exact_token_deep_in_a_file(name):
    before = VALID[name] * (20 if name in REPEATABLE else 1)
    line, token = FAULTS[name]
    assert syntax.verdict(name, before) == ("valid", None, None)
    assert syntax.verdict(name, before + line + "\n") == ("failing", before.count("\n") + 1, token)


def test_line_ends_and_indentation_have_places():
    assert syntax.verdict("python", "x = 1\n\n\ndef f(x)\n    return x\n") == ("failing", 4, "\n")
    assert syntax.verdict("python", "x = 1\ny = 2\n    z = 3\n") == ("failing", 3, "z")
    assert syntax.verdict("go", "package a\n\n\nfunc f()\n{\n}\n")[1:] == (5, "{")


YAML_VALID = [
    'a:\n- x\n- y\nb: 1\n',
    '- - x\n  - y\n- z\n',
    'a: &x\n  b: 1\nc: *x\n',
    '- !t\n  a: 1\n',
    '- &q a: 1\n  b: 2\n',
    '&k a: 1\n',
    "a: 'one\n  two'\nb: 1\n",
    'a: "x\n\n  y"\n',
    'a: [1,\n  2, {b: c},\n]\n',
    "a: {b: 'x, y', c: [1]}\n",
    'text that\nruns on\n',
    'a: text\n  that runs\n  on\nb: 1\n',
    'a: |\n  x\n   y\n\n  z\nb: >-\n  q\n',
    '? a\n: b\n',
    '--- # c\na: 1\n--- |\n x\n',
    '--- text\n',
    'a:\n  - b: 1\n    c:\n      - d\n  - e\n',
    'a: http://x:80/y\n',
    'a:\n\n\n',
    '- a\n-\n- b:\n    c\n',
    '{a: 1}\n',
    '[a, b]\n',
    '{"a":1,"b":[{}]}\n',
    'key with spaces: v # c\n',
    'a: b#c\n',
    '"q k": 1\n',
    'a: []\nb: {}\n',
    'a: !!str 1\n',
    'a: x:y\n',
    "steps:\n  - run: |\n      a\n      b\n    name: q\n  - uses: x@v1\n    with: {a: '${{ b }}'}\n",
    'a: -b\n',
    "'it''s': 'x''y'\n",
]
YAML_INVALID = [
    'a: 1\n b: 2\n',
    "a: 'x\nb: 1\n",
    'a: [1, 2\nb: 1\n',
    'a: b: c\n',
    'a: 1\n- b\n',
    '- a\nb: 1\n',
    'a:\n  b: 1\n c: 2\n',
    '\ta: 1\n',
    "a: 'x' y\n",
    'a: @x\n',
    'a: {b: 1]\n',
    'a: [1, 2]]\n',
    'a: "x\n',
    'a:\n  - b\n  c: 1\n',
    'a: 1\nb\nc: 2\n',
    '<<<<<<< HEAD\na: 1\n=======\na: 2\n>>>>>>> x\n',
    'a: |\nb\n',
]


@pytest.mark.parametrize("text", YAML_VALID)
def test_yaml_valid(text):
    assert language("yaml").check(text) is None


@pytest.mark.parametrize("text", YAML_INVALID)
def test_yaml_invalid(text):
    assert language("yaml").check(text) is not None


def test_yaml_places():
    assert language("yaml").check('a: 1\n b: 2\n')[:2] == ("failing", 2)
    assert language("yaml").check("a: 'x\nb: 1\n")[:2] == ("failing", 2)
    assert language("yaml").check('a:\n  b: 1\n c: 2\n')[:2] == ("failing", 3)
    assert language("yaml").check('a: {b: 1]\n')[:2] == ("failing", 1)
    assert language("yaml").check('a:\n  - b\n  c: 1\n')[:2] == ("failing", 3)


@pytest.mark.parametrize("name", [n for n in VALID if n not in ("yaml", "json", "shell")])
def test_plug_in_of_the_quality_filter(name):
    parse = syntax.core_parser()
    assert parse([name], [VALID[name]]) == [False] and parse([name], [BROKEN[name]]) == [True]


def test_rule_of_the_parser_in_the_core(spark):
    from siltstone.operators import filters

    words = "amber birch cedar delta ember fjord grove heath inlet jetty knoll ledge marsh notch oasis".split()
    body = "".join(f"func {w}{i}({w} int) string {{\n\tlog.Print(\"{w * 2} {i * 37}\")\n\treturn show{w.title()}({w} + {i * i})\n}}\n\n" for i, w in enumerate(words))
    rows = [("good", "Go", "package a\n\n" + body), ("bad", "Go", "package a\n\n" + body + "func (\n")]
    df = spark.createDataFrame(rows, "document_id string, language string, content string")
    out = {r["document_id"]: r["rejection_reason"] for r in filters.quality_filter(df, syntax.core_parser()).collect()}
    assert out == {"good": None, "bad": "parse_error"}
