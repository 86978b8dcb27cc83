"""A small sandboxed template language, compiled to Python closures.

``{{ expression }}`` prints, ``{# #}`` is a comment, and ``{% %}`` holds ``for x in y``, ``if``,
``elif``, ``else``, ``set x = e``, ``generation`` and their ``end...``; a dash inside a mark strips
the white space on its side. Expressions have strings, numbers, ``true``, ``false``, ``none``,
names, ``a.b``, ``a[b]``, ``+ - * ~``, comparisons, ``in``, ``not``, ``and``, ``or``, ``x if c else
y`` and filters ``a | f(b)``. There is no call but filters, attributes are keys of mappings only,
and nothing of Python is reachable. What is unknown is none and prints as nothing.

A source is parsed into a syntax tree, constant parts are folded, and each node becomes a closure.
Rendering yields ``(text, in generation)`` pieces one by one, and ``for`` reads its list lazily with
one item ahead, so a long conversation is never held as a whole.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

Value = object
Scope = dict[str, Value]
Pieces = Iterator[tuple[str, bool]]


class TemplateError(ValueError):
    """The source isn't a template."""


@dataclass(frozen=True)
class Const:
    value: Value


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Op:
    """An operator or filter over its arguments."""

    name: str
    args: tuple
    is_filter: bool = False


@dataclass(frozen=True)
class Choice:
    condition: object
    yes: object
    no: object


@dataclass(frozen=True)
class Print:
    value: object


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class If:
    condition: object
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class For:
    name: str
    items: object
    body: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


def _text(value: Value) -> str:
    return "" if value is None else "true" if value is True else "false" if value is False else str(value)


def _within(a: Value, b: Value) -> bool:
    return isinstance(b, (str, list, tuple, Mapping)) and (not isinstance(b, str) or isinstance(a, str)) and a in b


def _plus(a: Value, b: Value) -> Value:
    return _text(a) + _text(b) if isinstance(a, str) or isinstance(b, str) else (a or 0) + (b or 0)


OPERATORS: dict[str, Callable] = {
    "+": _plus, "~": lambda a, b: _text(a) + _text(b), "-": operator.sub, "*": lambda a, b: _number(a) * _number(b),
    "==": operator.eq, "!=": operator.ne, "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge,
    "in": _within, "not": operator.not_, "and": lambda a, b: a and b, "or": lambda a, b: a or b,
}
FILTERS: dict[str, Callable] = {
    "trim": lambda x: _text(x).strip(), "upper": lambda x: _text(x).upper(), "lower": lambda x: _text(x).lower(),
    "length": lambda x: len(x) if isinstance(x, (str, list, tuple, Mapping)) else 0,
    "default": lambda x, other="": other if x is None else x,
    "replace": lambda x, old, new: _text(x).replace(_text(old), _text(new)),
}


def _number(value: Value) -> int | float:
    if isinstance(value, (int, float)):
        return value
    raise TypeError("only numbers are multiplied")  # a text times a number could be of any size


_MARK = re.compile(r"\{\{(-?)(.*?)(-?)\}\}|\{%(-?)(.*?)(-?)%\}|\{#(-?)(.*?)(-?)#\}", re.S)
_TOKEN = re.compile(r"""\s*(?:(\d+\.\d+|\d+)|("(?:[^"\\]|\\.)*"|'(?:[^'\\]|\\.)*')|([A-Za-z_]\w*)|(==|!=|<=|>=|[-+*~<>|.,()\[\]=]))""", re.S)
_LEVELS = (("or",), ("and",), ("not",), ("==", "!=", "<", "<=", ">", ">=", "in", "not in"), ("+", "-", "~"), ("*",))
_BACKSLASH = {"n": "\n", "t": "\t", "r": "\r"}


class _Expression:
    """A parser of one expression by falling precedence."""

    def __init__(self, source: str) -> None:
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            if (m := _TOKEN.match(source, at)) is None:
                raise TemplateError(f"not understood: {source[at:]!r}")
            kind = ("number", "string", "name", "mark")[m.lastindex - 1]
            self.tokens.append((kind, m[m.lastindex]))
            at = m.end()
        self.at = 0

    def peek(self, ahead: int = 0) -> str | None:
        kind, text = self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ("", None)
        return None if kind == "string" else text

    def take(self, *wanted: str) -> str | None:
        if (text := self.peek()) is not None and text in wanted:
            self.at += 1
            return text
        return None

    def need(self, text: str) -> None:
        if not self.take(text):
            raise TemplateError(f"{text!r} is missing")

    def name(self) -> str:
        if self.at < len(self.tokens) and self.tokens[self.at][0] == "name":
            self.at += 1
            return self.tokens[self.at - 1][1]
        raise TemplateError("a name is missing")

    def whole(self) -> object:
        node = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"left over: {self.tokens[self.at][1]!r}")
        return node

    def choice(self) -> object:
        node = self.level(0)
        if self.take("if"):
            condition = self.level(0)
            other = self.choice() if self.take("else") else Const(None)
            return Choice(condition, node, other)
        return node

    def level(self, k: int) -> object:
        if k == len(_LEVELS):
            return self.filtered()
        if _LEVELS[k] == ("not",):
            return Op("not", (self.level(k),)) if self.take("not") else self.level(k + 1)
        node = self.level(k + 1)
        while True:
            if "not in" in _LEVELS[k] and self.peek() == "not" and self.peek(1) == "in":
                self.at += 2
                node = Op("not", (Op("in", (node, self.level(k + 1))),))
            elif found := self.take(*_LEVELS[k]):
                node = Op(found, (node, self.level(k + 1)))
            else:
                return node

    def filtered(self) -> object:
        node = self.atom()
        while found := self.take("|", ".", "["):
            if found == "|":
                name, args = self.name(), [node]
                if self.take("("):
                    while not self.take(")"):
                        args.append(self.choice())
                        if not self.take(","):
                            self.need(")")
                            break
                node = Op(name, tuple(args), True)
            elif found == ".":
                node = Item(node, Const(self.name()))
            else:
                node = Item(node, self.choice())
                self.need("]")
        return node

    def atom(self) -> object:
        if self.take("("):
            node = self.choice()
            self.need(")")
            return node
        if self.at == len(self.tokens):
            raise TemplateError("an expression is missing")
        kind, text = self.tokens[self.at]
        self.at += 1
        if kind == "number":
            return Const(float(text) if "." in text else int(text))
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _BACKSLASH.get(m[1], m[1]), text[1:-1], flags=re.S))
        if kind == "name":
            known = {"true": True, "false": False, "none": None}
            return Const(known[text.lower()]) if text.lower() in known else Name(text)
        raise TemplateError(f"unexpected {text!r}")


def parse(source: str) -> tuple:
    """The syntax tree of a template."""
    parts: list[tuple[str, str]] = []
    at, strip = 0, False
    for m in _MARK.finditer(source):
        kind = 0 if m[2] is not None else 1 if m[5] is not None else 2
        left, inner, right = m.group(3 * kind + 1, 3 * kind + 2, 3 * kind + 3)
        text = source[at: m.start()]
        text = text.lstrip() if strip else text
        parts += [("text", text.rstrip() if left else text), (("print", "statement", "comment")[kind], inner)]
        at, strip = m.end(), bool(right)
    parts.append(("text", source[at:].lstrip() if strip else source[at:]))
    place = 0

    def body(*ends: str) -> tuple[tuple, str, str]:
        """Nodes up to one of the statements ``ends``, that statement and what follows it there."""
        nonlocal place
        nodes: list = []
        while place < len(parts):
            kind, inner = parts[place]
            place += 1
            if kind == "text" and inner:
                nodes.append(Print(Const(inner)))
            elif kind == "print":
                nodes.append(Print(_Expression(inner).whole()))
            elif kind == "statement":
                word, _, rest = inner.strip().partition(" ")
                if word in ends:
                    return tuple(nodes), word, rest
                nodes.append(statement(word, rest))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(nodes), "", ""

    def branch(condition: str) -> If:
        yes, word, rest = body("elif", "else", "endif")
        no = (branch(rest),) if word == "elif" else body("endif")[0] if word == "else" else ()
        return If(_Expression(condition).whole(), yes, no)

    def statement(word: str, rest: str) -> object:
        if word == "if":
            return branch(rest)
        if word == "for":
            e = _Expression(rest)
            name = e.name()
            e.need("in")
            return For(name, e.whole(), body("endfor")[0])
        if word == "set":
            e = _Expression(rest)
            name = e.name()
            e.need("=")
            return Set(name, e.whole())
        if word == "generation":
            return Generation(body("endgeneration")[0])
        raise TemplateError(f"unknown statement {word!r}")

    return body()[0]


def fold(node: object, filters: Mapping[str, Callable]) -> object:
    """The node with its constant parts computed."""
    if isinstance(node, tuple):
        done: list = []
        for n in (fold(x, filters) for x in node):
            for part in n if isinstance(n, tuple) else (n,):
                if done and isinstance(part, Print) and isinstance(done[-1], Print) \
                        and isinstance(part.value, Const) and isinstance(done[-1].value, Const):
                    done[-1] = Print(Const(_text(done[-1].value.value) + _text(part.value.value)))
                else:
                    done.append(part)
        return tuple(done)
    if isinstance(node, Op):
        args = tuple(fold(a, filters) for a in node.args)
        if node.is_filter and node.name not in filters:
            raise TemplateError(f"unknown filter {node.name!r}")
        if all(isinstance(a, Const) for a in args):
            call = filters[node.name] if node.is_filter else OPERATORS[node.name]
            return Const(call(*(a.value for a in args)))
        return Op(node.name, args, node.is_filter)
    if isinstance(node, Item):
        return Item(fold(node.of, filters), fold(node.key, filters))
    if isinstance(node, Choice):
        condition, yes, no = (fold(x, filters) for x in (node.condition, node.yes, node.no))
        return (yes if condition.value else no) if isinstance(condition, Const) else Choice(condition, yes, no)
    if isinstance(node, Print):
        return Print(fold(node.value, filters))
    if isinstance(node, Set):
        return Set(node.name, fold(node.value, filters))
    if isinstance(node, If):
        condition, yes, no = (fold(x, filters) for x in (node.condition, node.yes, node.no))
        return (yes if condition.value else no) if isinstance(condition, Const) else If(condition, yes, no)
    if isinstance(node, For):
        return For(node.name, fold(node.items, filters), fold(node.body, filters))
    if isinstance(node, Generation):
        return Generation(fold(node.body, filters))
    return node


def _item(of: Value, key: Value) -> Value:
    if isinstance(of, Mapping):
        return of.get(key)
    if isinstance(of, (list, tuple, str)) and isinstance(key, int) and -len(of) <= key < len(of):
        return of[key]
    return None


def _evaluate(node: object, filters: Mapping[str, Callable]) -> Callable[[Scope], Value]:
    if isinstance(node, Const):
        return lambda scope, value=node.value: value
    if isinstance(node, Name):
        return lambda scope, name=node.name: scope.get(name)
    if isinstance(node, Item):
        of, key = _evaluate(node.of, filters), _evaluate(node.key, filters)
        return lambda scope: _item(of(scope), key(scope))
    if isinstance(node, Choice):
        condition, yes, no = (_evaluate(x, filters) for x in (node.condition, node.yes, node.no))
        return lambda scope: yes(scope) if condition(scope) else no(scope)
    args = [_evaluate(a, filters) for a in node.args]
    if node.name in ("and", "or") and not node.is_filter:
        a, b = args
        return (lambda scope: a(scope) and b(scope)) if node.name == "and" else (lambda scope: a(scope) or b(scope))
    call = filters[node.name] if node.is_filter else OPERATORS[node.name]
    return lambda scope: call(*(a(scope) for a in args))


def _render(nodes: tuple, filters: Mapping[str, Callable]) -> Callable[[Scope, bool], Pieces]:
    steps = [_step(n, filters) for n in nodes]

    def run(scope: Scope, marked: bool) -> Pieces:
        for step in steps:
            yield from step(scope, marked)

    return run


def _step(node: object, filters: Mapping[str, Callable]) -> Callable[[Scope, bool], Pieces]:
    if isinstance(node, Print):
        value = _evaluate(node.value, filters)

        def show(scope: Scope, marked: bool) -> Pieces:
            yield _text(value(scope)), marked

        return show
    if isinstance(node, Set):
        value = _evaluate(node.value, filters)

        def put(scope: Scope, marked: bool) -> Pieces:
            scope[node.name] = value(scope)
            yield from ()

        return put
    if isinstance(node, Generation):
        inner = _render(node.body, filters)
        return lambda scope, marked: inner(scope, True)
    if isinstance(node, If):
        condition = _evaluate(node.condition, filters)
        yes, no = _render(node.yes, filters), _render(node.no, filters)
        return lambda scope, marked: (yes if condition(scope) else no)(scope, marked)
    items, body = _evaluate(node.items, filters), _render(node.body, filters)

    def loop(scope: Scope, marked: bool) -> Pieces:
        source = iter(found if isinstance(found := items(scope), Iterable) else ())
        inner, end, index = dict(scope), object(), 0
        item = next(source, end)
        while item is not end:
            following = next(source, end)
            inner[node.name] = item
            inner["loop"] = {"index": index + 1, "index0": index, "first": not index, "last": following is end}
            yield from body(inner, marked)
            item, index = following, index + 1

    return loop


class Template:
    """A compiled template; ``filters`` are added to the built-in ones."""

    def __init__(self, source: str, filters: Mapping[str, Callable] | None = None) -> None:
        known = {**FILTERS, **(filters or {})}
        self.tree = fold(parse(source), known)
        self._run = _render(self.tree, known)

    def pieces(self, **scope: Value) -> Pieces:
        """Non-empty texts with whether they are inside a generation mark."""
        return ((text, marked) for text, marked in self._run(dict(scope), False) if text)

    def render(self, **scope: Value) -> str:
        return "".join(text for text, _ in self.pieces(**scope))
