"""A small sandboxed template language, compiled to Python closures.

Text stands for itself; `{{ expr }}` prints, `{% ... %}` controls:

    {% for m in messages %} ... {% endfor %}     (with loop.first, loop.last, loop.index0)
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% generation %} ... {% endgeneration %}     (text the model is trained to produce)

Expressions: string and whole-number literals, names, `a.b`, `+`, `==`, `!=`,
`in`, `not`, `and`, `or`, brackets, and the filters of `FILTERS` (`a | trim`).
There are no calls, no subscripts and no attributes but the fields of a
message and of the loop, so a template can't reach anything else.

A template is parsed to a syntax tree, constants are folded (constant
expressions, branches that can't be taken, neighbouring texts) and the tree
becomes closures. Rendering is a stream: messages are pulled one by one and
pieces of text come out, each with a mark whether it stands under a
generation block.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

# Strings that structure the output; texts must not contain them as they are.
CONTROLS = ("<|im_start|>", "<|im_sep|>", "<|im_end|>", "<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
ESCAPE = "\\"
_CONTROL = re.compile("|".join(re.escape(c) for c in CONTROLS))
_ESCAPED = re.compile(r"\\(\\?)")


def escape(text: str) -> str:
    """Double every escape character, then put one after the first character of every control string."""
    return _CONTROL.sub(lambda m: m[0][0] + ESCAPE + m[0][1:], text.replace(ESCAPE, ESCAPE * 2))


def unescape(text: str) -> str:
    """Undo `escape`: an escape character is dropped, a doubled one is a single one."""
    return _ESCAPED.sub(r"\1", text)


FILTERS: dict[str, Callable[[str], str]] = {
    "escape": escape,
    "trim": str.strip,
    "upper": str.upper,
    "lower": str.lower,
}
LOOP_FIELDS = ("first", "last", "index0")
MESSAGE_FIELDS = ("role", "text")


class TemplateError(ValueError):
    pass


# Syntax tree ---------------------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Field:
    name: str
    field: str


@dataclass(frozen=True)
class Op:
    kind: str
    args: tuple


@dataclass(frozen=True)
class Text:
    value: str


@dataclass(frozen=True)
class Print:
    expr: object


@dataclass(frozen=True)
class For:
    name: str
    body: tuple


@dataclass(frozen=True)
class If:
    # (condition, body) pairs; the condition of `else` is Const(True).
    branches: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# Parsing -------------------------------------------------------------------------------------------------------------

_TAG = re.compile(r"\{\{(.*?)\}\}|\{%(.*?)%\}", re.S)
_TOKEN = re.compile(r"\s*(?:(?P<str>'(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(?P<int>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<op>==|!=|[+|.()]))")
_ESCAPES = {"n": "\n", "t": "\t"}


def _tokens(source: str) -> list[tuple[str, str]]:
    out, at = [], 0
    source = source.strip()
    while at < len(source):
        m = _TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        out.append((m.lastgroup, m[m.lastgroup]))
        at = m.end()
    return out


class _Expression:
    """Precedence climbing: or, and, not, comparison, +, filter, atom."""

    def __init__(self, source: str, names: tuple[str, ...]):
        self.tokens, self.at, self.names = _tokens(source), 0, names

    def peek(self) -> tuple[str, str]:
        return self.tokens[self.at] if self.at < len(self.tokens) else ("end", "")

    def take(self, *values: str) -> str | None:
        if self.peek()[1] in values and self.peek()[0] != "str":
            self.at += 1
            return self.tokens[self.at - 1][1]
        return None

    def whole(self) -> object:
        out = self.either()
        if self.peek()[0] != "end":
            raise TemplateError(f"unexpected {self.peek()[1]!r}")
        return out

    def either(self) -> object:
        left = self.both()
        while self.take("or"):
            left = Op("or", (left, self.both()))
        return left

    def both(self) -> object:
        left = self.negated()
        while self.take("and"):
            left = Op("and", (left, self.negated()))
        return left

    def negated(self) -> object:
        return Op("not", (self.negated(),)) if self.take("not") else self.compared()

    def compared(self) -> object:
        left = self.added()
        kind = self.take("==", "!=", "in")
        return Op(kind, (left, self.added())) if kind else left

    def added(self) -> object:
        left = self.filtered()
        while self.take("+"):
            left = Op("+", (left, self.filtered()))
        return left

    def filtered(self) -> object:
        left = self.atom()
        while self.take("|"):
            kind, name = self.peek()
            if kind != "name" or name not in FILTERS:
                raise TemplateError(f"no filter {name!r}")
            self.at += 1
            left = Op("|" + name, (left,))
        return left

    def atom(self) -> object:
        kind, value = self.peek()
        self.at += 1
        if kind == "str":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind == "int":
            return Const(int(value))
        if value == "(" and kind == "op":
            inner = self.either()
            if not self.take(")"):
                raise TemplateError("a bracket is not closed")
            return inner
        if kind == "name" and value in ("true", "false"):
            return Const(value == "true")
        if kind == "name" and value in self.names and self.take("."):
            field = self.peek()[1]
            self.at += 1
            if field not in (LOOP_FIELDS if value == "loop" else MESSAGE_FIELDS):
                raise TemplateError(f"no field {value}.{field}")
            return Field(value, field)
        raise TemplateError(f"unexpected {value!r}")


def parse(source: str) -> tuple:
    """The template's syntax tree."""
    pieces, at = [], 0
    for m in _TAG.finditer(source):
        pieces.append(("text", source[at : m.start()]))
        pieces.append(("print", m[1]) if m[1] is not None else ("tag", m[2].strip()))
        at = m.end()
    pieces.append(("text", source[at:]))

    def body(names: tuple[str, ...], until: tuple[str, ...]) -> tuple[tuple, str]:
        out = []
        while pieces:
            kind, value = pieces.pop(0)
            word, _, rest = value.partition(" ")
            if kind == "text":
                if value:
                    out.append(Text(value))
            elif kind == "print":
                out.append(Print(_Expression(value, names).whole()))
            elif word in until:
                return tuple(out), value
            elif m := re.fullmatch(r"for\s+([A-Za-z_]\w*)\s+in\s+messages", value):
                if names:
                    raise TemplateError("loops do not nest: messages are a stream")
                inner, _ = body((m[1], "loop"), ("endfor",))
                out.append(For(m[1], inner))
            elif word == "if":
                branches, condition, end = [], _Expression(rest, names).whole(), ""
                while end != "endif":
                    inner, end = body(names, ("elif", "else", "endif"))
                    branches.append((condition, inner))
                    word, _, rest = end.partition(" ")
                    condition = _Expression(rest, names).whole() if word == "elif" else Const(True)
                out.append(If(tuple(branches)))
            elif word == "generation":
                inner, _ = body(names, ("endgeneration",))
                out.append(Generation(inner))
            else:
                raise TemplateError(f"unexpected tag {value!r}")
        if until:
            raise TemplateError(f"missing {' or '.join(until)}")
        return tuple(out), ""

    return body((), ())[0]


# Folding -------------------------------------------------------------------------------------------------------------


def _apply(kind: str, values: list) -> object:
    if kind == "+":
        both_numbers = all(isinstance(v, int) and not isinstance(v, bool) for v in values)
        return sum(values) if both_numbers else "".join(map(str, values))
    if kind == "==":
        return values[0] == values[1]
    if kind == "!=":
        return values[0] != values[1]
    if kind == "in":
        return str(values[0]) in str(values[1])
    if kind == "not":
        return not values[0]
    return FILTERS[kind[1:]](str(values[0]))


def fold_expression(e: object) -> object:
    if not isinstance(e, Op):
        return e
    args = tuple(map(fold_expression, e.args))
    if e.kind in ("and", "or"):
        left, right = args
        if isinstance(left, Const):
            return right if bool(left.value) == (e.kind == "and") else left
        return Op(e.kind, args)
    if all(isinstance(a, Const) for a in args):
        return Const(_apply(e.kind, [a.value for a in args]))
    return Op(e.kind, args)


def fold(nodes: tuple) -> tuple:
    """The same tree without constant expressions, dead branches and neighbouring texts."""
    out: list = []

    def add(node) -> None:
        if isinstance(node, Text) and out and isinstance(out[-1], Text):
            out[-1] = Text(out[-1].value + node.value)
        elif not (isinstance(node, Text) and not node.value):
            out.append(node)

    for node in nodes:
        if isinstance(node, Print):
            e = fold_expression(node.expr)
            add(Text(str(e.value)) if isinstance(e, Const) else Print(e))
        elif isinstance(node, For):
            add(For(node.name, fold(node.body)))
        elif isinstance(node, Generation):
            add(Generation(fold(node.body)))
        elif isinstance(node, If):
            branches = []
            for condition, inner in node.branches:
                condition = fold_expression(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                branches.append((condition, fold(inner)))
                if isinstance(condition, Const):
                    break
            if branches and isinstance(branches[0][0], Const):
                for inner in branches[0][1]:
                    add(inner)
            elif branches:
                add(If(tuple(branches)))
        else:
            add(node)
    return tuple(out)


# Closures ------------------------------------------------------------------------------------------------------------

# A piece of output and whether the loss covers it.
Piece = tuple[str, bool]


def _value(e: object) -> Callable[[dict], object]:
    if isinstance(e, Const):
        return lambda env, v=e.value: v
    if isinstance(e, Field):
        return lambda env, n=e.name, f=e.field: env[n][f]
    args = [_value(a) for a in e.args]
    if e.kind == "and":
        return lambda env: args[0](env) and args[1](env)
    if e.kind == "or":
        return lambda env: args[0](env) or args[1](env)
    if len(args) == 1:
        return lambda env, k=e.kind, a=args[0]: _apply(k, [a(env)])
    return lambda env, k=e.kind: _apply(k, [a(env) for a in args])


def _writer(nodes: tuple, loss: bool) -> Callable[[dict, Iterator[dict]], Iterator[Piece]]:
    parts = [_node(n, loss) for n in nodes]

    def write(env: dict, messages: Iterator[dict]) -> Iterator[Piece]:
        for part in parts:
            yield from part(env, messages)

    return write


def _node(node: object, loss: bool) -> Callable[[dict, Iterator[dict]], Iterator[Piece]]:
    if isinstance(node, Text):
        piece = ((node.value, loss),)
        return lambda env, messages: piece
    if isinstance(node, Print):
        value = _value(node.expr)
        return lambda env, messages: ((str(value(env)), loss),)
    if isinstance(node, Generation):
        return _writer(node.body, True)
    if isinstance(node, If):
        branches = [(_value(c), _writer(b, loss)) for c, b in node.branches]

        def choose(env, messages):
            for condition, body in branches:
                if condition(env):
                    return body(env, messages)
            return ()

        return choose
    body = _writer(node.body, loss)

    def loop(env, messages):
        index, now = 0, next(messages, None)
        while now is not None:
            after = next(messages, None)
            inner = env | {node.name: now, "loop": {"first": index == 0, "last": after is None, "index0": index}}
            yield from body(inner, iter(()))
            index, now = index + 1, after

    return loop


def compile_template(source: str) -> Callable[[Iterable[dict]], Iterator[Piece]]:
    """A function from messages (dicts of role and text) to pieces of output."""
    write = _writer(fold(parse(source)), False)
    return lambda messages: (p for p in write({}, iter(messages)) if p[0])
