"""A small template language for chat formats, compiled to Python closures.

``{{ expression }}`` prints, ``{% for x in xs %} .. {% endfor %}`` repeats,
``{% if %} .. {% elif %} .. {% else %} .. {% endif %}`` chooses,
``{% generation %} .. {% endgeneration %}`` marks what a model is to learn,
``{# comment #}``. Expressions: literals, names, ``x.key``, ``==  !=  <  >  <=
>=  in  not in``, ``and or not``, ``+``, ``a if c else b``, ``x | filter``.

It is a sandbox by construction: names come from the context alone, keys only
look into mappings, filters are a fixed list, there are no calls, and loops run
over the context's own sequences. The source is parsed to a tree, constant
parts of the tree are folded, and each node becomes a closure. A loop's
sequence may be an iterator: one element ahead is read.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field
from functools import lru_cache
from typing import Any

FILTERS: dict[str, Callable[[Any], Any]] = {"trim": lambda x: x.strip(), "upper": lambda x: x.upper(),
                                            "lower": lambda x: x.lower(), "length": len}


class TemplateError(ValueError):
    """The source isn't a template of this language."""


# ---------------------------------------------------------------- tree

@dataclass(frozen=True)
class Const:
    value: Any


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: Any
    key: str


@dataclass(frozen=True)
class Apply:
    """A pure function of other expressions."""

    fn: Callable
    args: tuple


@dataclass(frozen=True)
class Choice:
    """``yes`` if ``test`` else ``no``; also stands for and / or."""

    test: Any
    yes: Any
    no: Any


@dataclass(frozen=True)
class Print:
    what: Any


@dataclass(frozen=True)
class For:
    name: str
    over: Any
    body: tuple


@dataclass(frozen=True)
class If:
    test: Any
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class Generation:
    body: tuple


# ---------------------------------------------------------------- parser

_TAGS = re.compile(r"(\{\{.*?\}\}|\{%.*?%\}|\{#.*?#\})", re.S)
_LEXEMES = re.compile(r"""\s*(?:(?P<number>\d+)|(?P<string>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<word>[A-Za-z]\w*)|"""
                      r"""(?P<mark>==|!=|<=|>=|[<>+().|]))""", re.S)
_ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}
_COMPARE = {"==": operator.eq, "!=": operator.ne, "<": operator.lt, ">": operator.gt, "<=": operator.le, ">=": operator.ge}
_WORDS = {"true": Const(True), "false": Const(False), "none": Const(None)}
_RESERVED = {"if", "else", "and", "or", "not", "in", "for"}


class Parser:
    def __init__(self, filters: dict[str, Callable]):
        self.filters = filters

    def parse(self, source: str) -> tuple:
        self.parts = [x for x in _TAGS.split(source) if x]
        self.at = 0
        body, stop = self._body()
        if stop:
            raise TemplateError(f"{stop} has no beginning")
        return body

    def _body(self, *stops: str) -> tuple[tuple, str]:
        out: list = []
        while self.at < len(self.parts):
            part = self.parts[self.at]
            self.at += 1
            if part.startswith("{#"):
                continue
            if part.startswith("{{"):
                out.append(Print(self._whole(part[2:-2])))
            elif part.startswith("{%"):
                word, _, rest = part[2:-2].strip().partition(" ")
                if word in ("endfor", "endif", "endgeneration", "else", "elif"):
                    if word not in stops:
                        raise TemplateError(f"{word} has no beginning")
                    self.rest = rest
                    return tuple(out), word
                out.append(self._statement(word, rest))
            else:
                out.append(Print(Const(part)))
        if stops:
            raise TemplateError(f"{stops[-1]} is missing")
        return tuple(out), ""

    def _statement(self, word: str, rest: str):
        if word == "for":
            found = re.fullmatch(r"\s*([A-Za-z]\w*)\s+in\s+(.+)", rest, re.S)
            if not found or found[1] in _RESERVED:
                raise TemplateError(f"for {rest}")
            over = self._whole(found[2])
            return For(found[1], over, self._body("endfor")[0])
        if word == "if":
            test = self._whole(rest)
            yes, stop = self._body("elif", "else", "endif")
            if stop == "elif":
                no = (self._statement("if", self.rest),)
            else:
                no = self._body("endif")[0] if stop == "else" else ()
            return If(test, yes, no)
        if word == "generation" and not rest.strip():
            return Generation(self._body("endgeneration")[0])
        raise TemplateError(f"unknown statement {word}")

    def _whole(self, text: str):
        self.tokens, place = [], 0
        text = text.strip()
        while place < len(text):
            found = _LEXEMES.match(text, place)
            if not found:
                raise TemplateError(f"can't read {text[place:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            place = found.end()
        self.next = 0
        tree = self._choice()
        if self.next < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.next][1]!r} is too much in {text!r}")
        return tree

    def _take(self, *values: str) -> str | None:
        if self.next < len(self.tokens) and self.tokens[self.next][0] != "string" and self.tokens[self.next][1] in values:
            self.next += 1
            return self.tokens[self.next - 1][1]
        return None

    def _need(self, value: str) -> None:
        if not self._take(value):
            raise TemplateError(f"{value!r} is missing")

    def _choice(self):
        yes = self._or()
        if not self._take("if"):
            return yes
        test = self._or()
        self._need("else")
        return Choice(test, yes, self._choice())

    def _or(self):
        left = self._and()
        while self._take("or"):
            left = Choice(left, left, self._and())
        return left

    def _and(self):
        left = self._not()
        while self._take("and"):
            left = Choice(left, self._not(), left)
        return left

    def _not(self):
        if self._take("not"):
            return Apply(operator.not_, (self._not(),))
        left = self._sum()
        if mark := self._take(*_COMPARE):
            return Apply(_COMPARE[mark], (left, self._sum()))
        if self._take("in"):
            return Apply(lambda a, b: a in b, (left, self._sum()))
        if self._take("not"):
            self._need("in")
            return Apply(lambda a, b: a not in b, (left, self._sum()))
        return left

    def _sum(self):
        left = self._filtered()
        while self._take("+"):
            left = Apply(operator.add, (left, self._filtered()))
        return left

    def _filtered(self):
        left = self._primary()
        while self._take("|"):
            kind, name = self.tokens[self.next] if self.next < len(self.tokens) else ("", "")
            if kind != "word" or name not in self.filters:
                raise TemplateError(f"unknown filter {name!r}")
            self.next += 1
            left = Apply(self.filters[name], (left,))
        return left

    def _primary(self):
        if self._take("("):
            inner = self._choice()
            self._need(")")
            return inner
        if self.next >= len(self.tokens):
            raise TemplateError("an expression ends too soon")
        kind, value = self.tokens[self.next]
        self.next += 1
        if kind == "number":
            return Const(int(value))
        if kind == "string":
            return Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), value[1:-1], flags=re.S))
        if kind != "word" or value in _RESERVED:
            raise TemplateError(f"{value!r} isn't expected")
        tree = _WORDS.get(value, Name(value))
        while self._take("."):
            kind, key = self.tokens[self.next] if self.next < len(self.tokens) else ("", "")
            if kind != "word":
                raise TemplateError("a key is missing")
            self.next += 1
            tree = Key(tree, key)
        return tree


# ---------------------------------------------------------------- folding

def fold(tree):
    """The same tree with constant expressions worked out."""
    if isinstance(tree, Key):
        return Key(fold(tree.of), tree.key)
    if isinstance(tree, Apply):
        args = tuple(map(fold, tree.args))
        if all(isinstance(x, Const) for x in args):
            return Const(tree.fn(*(x.value for x in args)))
        return Apply(tree.fn, args)
    if isinstance(tree, Choice):
        test = fold(tree.test)
        if isinstance(test, Const):
            return fold(tree.yes if test.value else tree.no)
        return Choice(test, fold(tree.yes), fold(tree.no))
    return tree


def fold_body(body: tuple) -> tuple:
    """Statements with constant choices made and neighbouring texts joined."""
    out: list = []
    for node in body:
        if isinstance(node, Print):
            own: tuple = (Print(fold(node.what)),)
        elif isinstance(node, If):
            test = fold(node.test)
            yes, no = fold_body(node.yes), fold_body(node.no)
            own = (yes if test.value else no) if isinstance(test, Const) else (If(test, yes, no),)
        elif isinstance(node, For):
            own = (For(node.name, fold(node.over), fold_body(node.body)),)
        else:
            own = (Generation(fold_body(node.body)),)
        for x in own:
            if isinstance(x, Print) and isinstance(x.what, Const):
                text = "" if x.what.value is None else str(x.what.value)
                if out and isinstance(out[-1], Print) and isinstance(out[-1].what, Const):
                    text = out.pop().what.value + text
                if text:
                    out.append(Print(Const(text)))
            else:
                out.append(x)
    return tuple(out)


# ---------------------------------------------------------------- closures

@dataclass
class Output:
    """Collects printed text in pieces, and which code points are to be learned."""

    size: int = 0
    learning: int = 0
    pieces: list[str] = field(default_factory=list)
    marks: list[list[int]] = field(default_factory=list)

    def write(self, text: str) -> None:
        if not text:
            return
        if self.learning:
            if self.marks and self.marks[-1][1] == self.size:
                self.marks[-1][1] += len(text)
            else:
                self.marks.append([self.size, self.size + len(text)])
        self.pieces.append(text)
        self.size += len(text)

    def take(self) -> tuple[str, list[list[int]]]:
        """What is printed so far, and its marks; then starts anew."""
        taken = "".join(self.pieces), self.marks
        self.size, self.pieces, self.marks = 0, [], []
        return taken


Step = Callable[[dict, Output], Iterable[None]]


def value_of(tree) -> Callable[[dict], Any]:
    if isinstance(tree, Const):
        value = tree.value
        return lambda context: value
    if isinstance(tree, Name):
        name = tree.name
        return lambda context: context.get(name)
    if isinstance(tree, Key):
        of, key = value_of(tree.of), tree.key

        def look(context):
            found = of(context)
            return found.get(key) if isinstance(found, dict) else None
        return look
    if isinstance(tree, Choice):
        test, yes, no = value_of(tree.test), value_of(tree.yes), value_of(tree.no)
        return lambda context: yes(context) if test(context) else no(context)
    fn, args = tree.fn, tuple(map(value_of, tree.args))
    if len(args) == 1:
        only = args[0]
        return lambda context: fn(only(context))
    left, right = args
    return lambda context: fn(left(context), right(context))


def steps_of(body: tuple) -> Step:
    steps = [_step_of(node) for node in body]

    def run(context, out):
        for step in steps:
            yield from step(context, out)
    return run


def _step_of(node) -> Step:
    if isinstance(node, Print):
        what = value_of(node.what)

        def show(context, out):
            value = what(context)
            out.write("" if value is None else value if isinstance(value, str) else str(value))
            return ()
        return show
    if isinstance(node, If):
        test, yes, no = value_of(node.test), steps_of(node.yes), steps_of(node.no)
        return lambda context, out: (yes if test(context) else no)(context, out)
    if isinstance(node, Generation):
        body = steps_of(node.body)

        def learn(context, out):
            out.learning += 1
            yield from body(context, out)
            out.learning -= 1
        return learn
    name, over, inner = node.name, value_of(node.over), steps_of(node.body)

    def repeat(context, out):
        items = iter(over(context) or ())
        own = dict(context)
        ahead, k = next(items, None), 0
        while ahead is not None:
            item, ahead = ahead, next(items, None)
            own[name] = item
            own["loop"] = {"index0": k, "index": k + 1, "first": k == 0, "last": ahead is None}
            yield from inner(own, out)
            yield None  # an element is done: the caller may take what is printed
            k += 1
    return repeat


class Template:
    """``run(context, output)`` prints into an :class:`Output` and pauses after
    each element of a loop."""

    def __init__(self, source: str, filters: dict[str, Callable] | None = None):
        self.tree = fold_body(Parser({**FILTERS, **(filters or {})}).parse(source))
        self.run = steps_of(self.tree)

    def render(self, **context) -> tuple[str, list[list[int]]]:
        """The whole text, and the [start, stop) marks of what is to be learned."""
        out = Output()
        for _ in self.run(context, out):
            pass
        return out.take()


@lru_cache
def compiled(source: str, filters: tuple = ()) -> Template:
    return Template(source, dict(filters))
