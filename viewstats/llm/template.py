"""A sandboxed template language for conversations, compiled to Python closures.

    {{ expr }}                                  output of an expression
    {% for x in expr %} .. {% endfor %}         with loop.index, loop.index0, loop.first, loop.last
    {% if expr %} .. {% elif expr %} .. {% else %} .. {% endif %}
    {% set x = expr %}
    {% generation %} .. {% endgeneration %}     output that a model is to learn
    expr: 'text', 12, true, false, none, name, a.b, a['b'], a | filter, not, and, or,
          == != < <= > >= in, + - ~ (joins as text), parentheses

A template reads the fields of dictionaries and the items of lists it is given and nothing else: it
has no calls, no attributes of objects and no loops but over lists. A newline directly after a {% %}
tag is dropped. An undefined name or field is none, which prints as nothing.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from typing import Any

TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}\n?", re.S)
TOKEN = re.compile(r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)
    |(?P<name>[A-Za-z_]\w*)|(?P<sign>==|!=|<=|>=|[-+~<>|().\[\]=]))""", re.X)
ESCAPED = {"n": "\n", "t": "\t", "\\": "\\", "'": "'", '"': '"'}
CONSTANTS = {"true": True, "false": False, "none": None}
BINDING = [{"or"}, {"and"}, {"==", "!=", "<", "<=", ">", ">=", "in"}, {"+", "-", "~"}]


class TemplateError(ValueError):
    """The template is not well formed, or an expression cannot be computed."""


@dataclass(frozen=True)
class Constant:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Field:
    of: Any
    key: Any


@dataclass(frozen=True)
class Operation:
    """An operator or filter over its operands."""
    sign: str
    of: tuple


@dataclass(frozen=True)
class Output:
    value: Any


@dataclass(frozen=True)
class Set:
    name: str
    value: Any


@dataclass(frozen=True)
class If:
    test: Any
    then: tuple
    other: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def shown(value) -> str:
    return "" if value is None else value if isinstance(value, str) else str(value)


FILTERS: dict[str, Callable] = {
    "trim": lambda v: shown(v).strip(), "upper": lambda v: shown(v).upper(),
    "lower": lambda v: shown(v).lower(), "length": lambda v: 0 if v is None else len(v)}
OPERATORS: dict[str, Callable] = {
    "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "<": lambda a, b: a < b,
    "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b,
    "in": lambda a, b: a in b, "+": lambda a, b: a + b, "-": lambda a, b: a - b,
    "~": lambda a, b: shown(a) + shown(b), "not": lambda a: not a}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str, filters: dict[str, Callable]):
        self.filters, self.tokens, at = filters, [], 0
        source = source.rstrip()
        while at < len(source):
            found = TOKEN.match(source, at)
            if not found:
                raise TemplateError(f"cannot read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        self.at = 0

    def next(self, *wanted: str) -> str | None:
        """Takes the next token if it is one of these signs or words."""
        if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" \
                and self.tokens[self.at][1] in wanted:
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def expect(self, sign: str) -> None:
        if not self.next(sign):
            raise TemplateError(f"{sign!r} is missing")

    def take(self, kind: str) -> str:
        if self.at >= len(self.tokens) or self.tokens[self.at][0] != kind:
            raise TemplateError(f"a {kind} is missing")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def whole(self):
        value = self.level(0)
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is out of place")
        return value

    def level(self, n: int):
        if n == len(BINDING):
            return self.unary()
        value = self.level(n + 1)
        while sign := self.next(*BINDING[n]):
            value = Operation(sign, (value, self.level(n + 1)))
        return value

    def unary(self):
        if self.next("not"):
            return Operation("not", (self.unary(),))
        value = self.primary()
        while sign := self.next(".", "[", "|"):
            if sign == ".":
                value = Field(value, Constant(self.take("name")))
            elif sign == "[":
                value = Field(value, self.level(0))
                self.expect("]")
            else:
                name = self.take("name")
                if name not in self.filters:
                    raise TemplateError(f"no filter {name!r}")
                value = Operation(f"|{name}", (value,))
        return value

    def primary(self):
        if self.next("("):
            value = self.level(0)
            self.expect(")")
            return value
        if self.at == len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            return Constant(re.sub(r"\\(.)", lambda m: ESCAPED.get(m[1], m[0]), token[1:-1], flags=re.S))
        if kind == "number":
            return Constant(int(token))
        if kind == "name":
            return Constant(CONSTANTS[token]) if token in CONSTANTS else Name(token)
        raise TemplateError(f"{token!r} is out of place")


def parse(source: str, filters: dict[str, Callable]) -> tuple:
    """The syntax tree of a template."""
    pieces, at = [], 0
    for tag in TAG.finditer(source):
        pieces += [("text", source[at:tag.start()])] * (tag.start() > at)
        pieces.append(("output", tag[1]) if tag[1] is not None else ("tag", tag[2].strip()))
        at = tag.end()
    pieces += [("text", source[at:])] * (at < len(source))
    pieces.reverse()

    def expression(text: str):
        return _Expression(text, filters).whole()

    def body(*ends: str) -> tuple[tuple, str]:
        """Nodes up to a tag that begins with one of `ends`, and that tag."""
        nodes = []
        while pieces:
            kind, text = pieces.pop()
            word, _, rest = text.partition(" ") if kind == "tag" else ("", "", "")
            if kind == "text":
                nodes.append(Output(Constant(text)))
            elif kind == "output":
                nodes.append(Output(expression(text)))
            elif word in ends:
                return tuple(nodes), text
            elif word == "for":
                found = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest.strip(), re.S)
                if not found:
                    raise TemplateError(f"cannot read {text!r}")
                nodes.append(For(found[1], expression(found[2]), body("endfor")[0]))
            elif word == "if":
                nodes.append(branch(rest))
            elif word == "set":
                name, _, value = rest.partition("=")
                if not name.strip().isidentifier():
                    raise TemplateError(f"cannot read {text!r}")
                nodes.append(Set(name.strip(), expression(value)))
            elif word == "generation":
                nodes.append(Generation(body("endgeneration")[0]))
            else:
                raise TemplateError(f"{text!r} is out of place")
        if ends:
            raise TemplateError(f"{ends[-1]!r} is missing")
        return tuple(nodes), ""

    def branch(test: str) -> If:
        then, end = body("elif", "else", "endif")
        word, _, rest = end.partition(" ")
        other = (branch(rest),) if word == "elif" else body("endif")[0] if word == "else" else ()
        return If(expression(test), then, other)

    return body()[0]


class Template:
    """A compiled template; `render` gives the text and where in it the generation blocks lie."""

    def __init__(self, source: str, filters: dict[str, Callable] | None = None):
        self.functions = OPERATORS | {f"|{k}": f for k, f in (FILTERS | (filters or {})).items()}
        self.tree = self.fold_body(parse(source, FILTERS | (filters or {})))
        self._run = self.compile_body(self.tree)

    # Folding: constants are computed once, constant branches chosen, neighbouring texts joined.

    def fold(self, node):
        if isinstance(node, Field):
            return Field(self.fold(node.of), self.fold(node.key))
        if not isinstance(node, Operation):
            return node
        of = tuple(map(self.fold, node.of))
        if node.sign in ("and", "or") and isinstance(of[0], Constant):
            return of[1] if bool(of[0].value) == (node.sign == "and") else of[0]
        if node.sign not in ("and", "or") and all(isinstance(x, Constant) for x in of):
            return Constant(self.compute(node.sign, *[x.value for x in of]))
        return Operation(node.sign, of)

    def fold_body(self, body: tuple) -> tuple:
        nodes: list = []
        for node in body:
            match node:
                case Output(value):
                    node = Output(self.fold(value))
                case Set(name, value):
                    node = Set(name, self.fold(value))
                case For(name, over, inner):
                    node = For(name, self.fold(over), self.fold_body(inner))
                case Generation(inner):
                    node = Generation(self.fold_body(inner))
                case If(test, then, other):
                    node = If(self.fold(test), self.fold_body(then), self.fold_body(other))
                    if isinstance(node.test, Constant):
                        nodes += node.then if node.test.value else node.other
                        continue
            nodes.append(node)
        joined: list = []
        for node in nodes:
            if isinstance(node, Output) and isinstance(node.value, Constant):
                text = shown(node.value.value)
                if joined and isinstance(joined[-1], Output) and isinstance(joined[-1].value, Constant):
                    text = joined.pop().value.value + text
                node = Output(Constant(text))
                if not text:
                    continue
            joined.append(node)
        return tuple(joined)

    def compute(self, sign: str, *values):
        try:
            return self.functions[sign](*values)
        except (TypeError, AttributeError) as wrong:
            raise TemplateError(f"{sign!r}: {wrong}") from wrong

    # Compiling: each node becomes a closure over its operands' closures.

    def compile(self, node) -> Callable[[dict], Any]:
        match node:
            case Constant(value):
                return lambda scope: value
            case Name(name):
                return lambda scope: scope.get(name)
            case Field(of, key):
                inner, at = self.compile(of), self.compile(key)

                def field(scope):
                    value, k = inner(scope), at(scope)
                    if isinstance(value, dict):
                        return value.get(k)
                    return value[k] if isinstance(value, list) and type(k) is int and k < len(value) else None
                return field
            case Operation("and", (a, b)):
                left, right = self.compile(a), self.compile(b)
                return lambda scope: left(scope) and right(scope)
            case Operation("or", (a, b)):
                left, right = self.compile(a), self.compile(b)
                return lambda scope: left(scope) or right(scope)
            case Operation(sign, (a,)):
                only = self.compile(a)
                return lambda scope: self.compute(sign, only(scope))
            case Operation(sign, (a, b)):
                left, right = self.compile(a), self.compile(b)
                return lambda scope: self.compute(sign, left(scope), right(scope))
        raise TemplateError(f"cannot compile {node}")

    def compile_body(self, body: tuple) -> Callable[[dict, _Out], None]:
        steps = tuple(map(self.compile_node, body))
        if len(steps) == 1:
            return steps[0]

        def run(scope, out):
            for step in steps:
                step(scope, out)
        return run

    def compile_node(self, node) -> Callable[[dict, _Out], None]:
        match node:
            case Output(Constant(value)):
                return lambda scope, out: out.put(value)
            case Output(value):
                get = self.compile(value)
                return lambda scope, out: out.put(shown(get(scope)))
            case Set(name, value):
                get = self.compile(value)
                return lambda scope, out: scope.__setitem__(name, get(scope))
            case If(test, then, other):
                holds, yes, no = self.compile(test), self.compile_body(then), self.compile_body(other)
                return lambda scope, out: yes(scope, out) if holds(scope) else no(scope, out)
            case Generation(inner):
                run = self.compile_body(inner)

                def generation(scope, out):
                    start = out.length
                    run(scope, out)
                    out.spans.append((start, out.length))
                return generation
            case For(name, over, inner):
                get, run = self.compile(over), self.compile_body(inner)

                def loop(scope, out):
                    items = get(scope) or []
                    if not isinstance(items, list):
                        raise TemplateError("a loop is over a list")
                    for i, item in enumerate(items):
                        run(scope | {name: item, "loop": {"index": i + 1, "index0": i, "first": i == 0,
                                                          "last": i == len(items) - 1}}, out)
                return loop
        raise TemplateError(f"cannot compile {node}")

    def render(self, scope: dict) -> tuple[str, list[tuple[int, int]]]:
        out = _Out()
        self._run(dict(scope), out)
        return "".join(out.parts), out.spans


class _Out:
    """Text put out so far and the spans of generation blocks in it, in code points."""

    def __init__(self):
        self.parts, self.length, self.spans = [], 0, []

    def put(self, text: str) -> None:
        self.parts.append(text)
        self.length += len(text)
