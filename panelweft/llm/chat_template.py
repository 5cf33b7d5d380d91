"""A small template language for chat formats, compiled to Python closures.

    {{ expr }}                          writes a value
    {% for x in expr %} ... {% endfor %}
    {% if expr %} ... {% elif expr %} ... {% else %} ... {% endif %}
    {% set name = expr %}               until the loop round or the template ends
    {% generation %} ... {% endgeneration %}   marks what a model is to learn
    {# comment #}; a dash inside a tag strips white space on its side

Expressions have strings, whole numbers, true, false, none, names, `x.key`,
`x['key']`, `x[0]`, + == != in, not in, and, or, not, `a if c else b`, parentheses
and filters after a bar. Inside a loop there are loop.index, loop.index0,
loop.first, loop.last.

It is a sandbox: there are no calls, no attributes of Python objects (a key is
looked up in a mapping, a number in a list), no filters but those handed in, and
no loops but over what is handed in, so that every rendering ends. A string may
have `MOST_CHARS` code points. Names that nothing defines are errors when the
template is compiled.

`compile_template` parses the source into a tree, replaces what only depends on
constants by its value (tests that are constant leave one branch, neighbouring
texts become one), and turns the tree into closures. A loop over all messages at
the top of a template is rendered round by round, so a conversation of any length
needs the memory of one message.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass, field

MOST_CHARS = 1 << 28


class TemplateError(ValueError):
    """The template is not well formed, or does what the sandbox forbids."""


# -- the tree ------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Item:
    of: object
    key: object


@dataclass(frozen=True)
class Binary:
    op: str
    left: object
    right: object


@dataclass(frozen=True)
class Not:
    of: object


@dataclass(frozen=True)
class Choice:
    test: object
    yes: object
    no: object


@dataclass(frozen=True)
class Filter:
    name: str
    of: object


@dataclass(frozen=True)
class Write:
    value: object


@dataclass(frozen=True)
class If:
    test: object
    yes: tuple
    no: tuple


@dataclass(frozen=True)
class For:
    name: str
    over: object
    body: tuple


@dataclass(frozen=True)
class Set:
    name: str
    value: object


@dataclass(frozen=True)
class Generation:
    body: tuple


# -- parsing -------------------------------------------------------------------

TAG = re.compile(r"(\{\{-?.*?-?\}\}|\{%-?.*?-?%\}|\{#.*?#\})", re.S)
TOKEN = re.compile(r"\s*(?:('(?:[^'\\]|\\.)*'|\"(?:[^\"\\]|\\.)*\")|(\d+)|([A-Za-z_]\w*)|(==|!=|[+.\[\]()|=]))")
WORDS = {"and", "or", "not", "in", "if", "else"}
VALUES = {"true": True, "false": False, "none": None, "True": True, "False": False, "None": None}
ESCAPES = {"n": "\n", "t": "\t", "r": "\r"}


def _tokens(source: str) -> list[tuple[str, object]]:
    out, at, source = [], 0, source.rstrip()
    while at < len(source):
        m = TOKEN.match(source, at)
        if not m:
            raise TemplateError(f"cannot read {source[at:]!r}")
        text, number, name, mark = m.groups()
        if text:
            out.append(("const", re.sub(r"\\(.)", lambda e: ESCAPES.get(e[1], e[1]), text[1:-1], flags=re.S)))
        elif number:
            out.append(("const", int(number)))
        elif name in VALUES:
            out.append(("const", VALUES[name]))
        else:
            out.append(("mark", name) if name in WORDS else ("name", name) if name else ("mark", mark))
        at = m.end()
    return out


class _Expression:
    """Reads one expression from tokens."""

    def __init__(self, source: str):
        self.source, self.tokens, self.at = source, _tokens(source), 0

    def peek(self, ahead: int = 0):
        return self.tokens[self.at + ahead] if self.at + ahead < len(self.tokens) else ("end", None)

    def take(self, mark: str) -> bool:
        if self.peek() == ("mark", mark):
            self.at += 1
            return True
        return False

    def need(self, mark: str) -> None:
        if not self.take(mark):
            raise TemplateError(f"{mark!r} is missing in {self.source!r}")

    def name(self) -> str:
        kind, value = self.peek()
        if kind != "name":
            raise TemplateError(f"a name is missing in {self.source!r}")
        self.at += 1
        return value

    def whole(self):
        found = self.choice()
        if self.at < len(self.tokens):
            raise TemplateError(f"cannot read the end of {self.source!r}")
        return found

    def choice(self):
        yes = self.either()
        if self.take("if"):
            test = self.either()
            self.need("else")
            return Choice(test, yes, self.choice())
        return yes

    def either(self):
        left = self.both()
        while self.take("or"):
            left = Binary("or", left, self.both())
        return left

    def both(self):
        left = self.negated()
        while self.take("and"):
            left = Binary("and", left, self.negated())
        return left

    def negated(self):
        return Not(self.negated()) if self.take("not") else self.compared()

    def compared(self):
        left = self.added()
        while True:
            if self.take("=="):
                left = Binary("==", left, self.added())
            elif self.take("!="):
                left = Binary("!=", left, self.added())
            elif self.take("in"):
                left = Binary("in", left, self.added())
            elif self.peek() == ("mark", "not") and self.peek(1) == ("mark", "in"):
                self.at += 2
                left = Not(Binary("in", left, self.added()))
            else:
                return left

    def added(self):
        left = self.postfix()
        while self.take("+"):
            left = Binary("+", left, self.postfix())
        return left

    def postfix(self):
        found = self.primary()
        while True:
            if self.take("."):
                found = Item(found, Const(self.name()))
            elif self.take("["):
                found = Item(found, self.choice())
                self.need("]")
            elif self.take("|"):
                found = Filter(self.name(), found)
            else:
                return found

    def primary(self):
        kind, value = self.peek()
        if kind == "const":
            self.at += 1
            return Const(value)
        if kind == "name":
            return Name(self.name())
        self.need("(")
        found = self.choice()
        self.need(")")
        return found


def _pieces(source: str) -> list[tuple[str, str]]:
    """The template cut into texts, writing tags and block tags."""
    out, strip = [], False
    for piece in TAG.split(source):
        kind = {"{{": "write", "{%": "block", "{#": "comment"}.get(piece[:2]) if TAG.fullmatch(piece) else "text"
        if kind == "text":
            out.append((kind, piece.lstrip() if strip else piece))
            strip = False
            continue
        inner = piece[2:-2]
        if kind != "comment":
            if inner.startswith("-"):
                inner = inner[1:]
                if out and out[-1][0] == "text":
                    out[-1] = ("text", out[-1][1].rstrip())
            strip = inner.endswith("-")
            inner = inner[:-1] if strip else inner
            out.append((kind, inner.strip()))
    return out


def parse(source: str) -> tuple:
    """The tree of a template: a tuple of nodes."""
    pieces = _pieces(source)
    at = 0

    def until(*ends: str) -> tuple[tuple, str]:
        nonlocal at
        nodes: list = []
        while at < len(pieces):
            kind, inner = pieces[at]
            at += 1
            if kind == "text":
                if inner:
                    nodes.append(Write(Const(inner)))
                continue
            if kind == "write":
                nodes.append(Write(_Expression(inner).whole()))
                continue
            word, _, rest = inner.partition(" ")
            if word in ends:
                return tuple(nodes), inner
            nodes.append(statement(word, rest, inner))
        if ends:
            raise TemplateError(f"{ends[-1]} is missing")
        return tuple(nodes), ""

    def statement(word: str, rest: str, inner: str):
        if word == "for":
            e = _Expression(rest)
            name = e.name()
            e.need("in")
            return For(name, e.whole(), until("endfor")[0])
        if word == "if":
            return branches(rest)
        if word == "set":
            e = _Expression(rest)
            name = e.name()
            e.need("=")
            return Set(name, e.whole())
        if inner == "generation":
            return Generation(until("endgeneration")[0])
        raise TemplateError(f"unknown tag {inner!r}")

    def branches(test: str):
        yes, end = until("elif", "else", "endif")
        no: tuple = ()
        if end.startswith("elif "):
            no = (branches(end[5:]),)
        elif end == "else":
            no, _ = until("endif")
        return If(_Expression(test).whole(), yes, no)

    return until()[0]


# -- values, as the sandbox sees them --------------------------------------------


def _text(value) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if value is None:
        return ""
    if isinstance(value, str | int):
        return str(value)
    raise TemplateError("only texts and numbers can be written")


def _item(of, key):
    if isinstance(of, Mapping):
        return of.get(key)
    if isinstance(of, list | tuple) and isinstance(key, int) and 0 <= key < len(of):
        return of[key]
    return None


def _add(a, b):
    if isinstance(a, int) and isinstance(b, int):
        return a + b
    out = _text(a) + _text(b)
    if len(out) > MOST_CHARS:
        raise TemplateError("a text became too long")
    return out


def _within(a, b):
    if isinstance(b, str):
        return isinstance(a, str) and a in b
    return isinstance(b, Mapping | list | tuple) and a in b


OPS: dict[str, Callable] = {"+": _add, "==": lambda a, b: a == b, "!=": lambda a, b: a != b, "in": _within}


# -- folding constants -------------------------------------------------------------


def fold(node, constants: Mapping[str, object], filters: Mapping[str, Callable]):
    """The same expression with all that is constant replaced by its value."""
    go = lambda x: fold(x, constants, filters)
    if isinstance(node, Name):
        return Const(constants[node.name]) if node.name in constants else node
    if isinstance(node, Item):
        of, key = go(node.of), go(node.key)
        both = isinstance(of, Const) and isinstance(key, Const)
        return Const(_item(of.value, key.value)) if both else Item(of, key)
    if isinstance(node, Not):
        of = go(node.of)
        return Const(not of.value) if isinstance(of, Const) else Not(of)
    if isinstance(node, Choice):
        test = go(node.test)
        if isinstance(test, Const):
            return go(node.yes if test.value else node.no)
        return Choice(test, go(node.yes), go(node.no))
    if isinstance(node, Filter):
        if node.name not in filters:
            raise TemplateError(f"no filter {node.name!r}")
        of = go(node.of)
        return Const(filters[node.name](of.value)) if isinstance(of, Const) else Filter(node.name, of)
    if isinstance(node, Binary):
        left, right = go(node.left), go(node.right)
        if node.op in ("and", "or"):
            if isinstance(left, Const):
                return right if bool(left.value) == (node.op == "and") else left
        elif isinstance(left, Const) and isinstance(right, Const):
            return Const(OPS[node.op](left.value, right.value))
        return Binary(node.op, left, right)
    return node


def _assigned(nodes: tuple) -> set[str]:
    """Names that a template gives values to, which are no constants in it."""
    out: set[str] = set()
    for node in nodes:
        if isinstance(node, Set | For):
            out.add(node.name)
        for part in ("body", "yes", "no"):
            out |= _assigned(getattr(node, part, ()))
    return out


def fold_all(nodes: tuple, constants: Mapping[str, object], filters: Mapping[str, Callable]) -> tuple:
    """Nodes with constants folded, dead branches gone, texts joined."""
    go = lambda x: fold(x, constants, filters)
    out: list = []
    for node in nodes:
        if isinstance(node, If):
            test = go(node.test)
            yes, no = (fold_all(x, constants, filters) for x in (node.yes, node.no))
            new = (yes if test.value else no) if isinstance(test, Const) else (If(test, yes, no),)
        elif isinstance(node, For):
            new = (For(node.name, go(node.over), fold_all(node.body, constants, filters)),)
        elif isinstance(node, Generation):
            new = (Generation(fold_all(node.body, constants, filters)),)
        elif isinstance(node, Set):
            new = (Set(node.name, go(node.value)),)
        else:
            value = go(node.value)
            new = (Write(Const(_text(value.value)) if isinstance(value, Const) else value),)
        for n in new:
            last = out[-1] if out else None
            if isinstance(n, Write) and isinstance(n.value, Const):
                if not n.value.value:
                    continue
                if isinstance(last, Write) and isinstance(last.value, Const):
                    out[-1] = Write(Const(last.value.value + n.value.value))
                    continue
            out.append(n)
    return tuple(out)


# -- closures ------------------------------------------------------------------------


@dataclass
class Sheet:
    """What has been written since it was last taken, with generation spans."""

    parts: list[str] = field(default_factory=list)
    spans: list[tuple[int, int]] = field(default_factory=list)
    size: int = 0

    def write(self, text: str) -> None:
        self.parts.append(text)
        self.size += len(text)

    def take(self) -> tuple[str, list[tuple[int, int]]]:
        out = "".join(self.parts), self.spans
        self.parts, self.spans, self.size = [], [], 0
        return out


def _value(node, known: frozenset, filters: Mapping[str, Callable]) -> Callable[[dict], object]:
    make = lambda x: _value(x, known, filters)
    if isinstance(node, Const):
        value = node.value
        return lambda scope: value
    if isinstance(node, Name):
        name = node.name
        if name not in known:
            raise TemplateError(f"nothing defines {name!r}")
        return lambda scope: scope[name]
    if isinstance(node, Item):
        of, key = make(node.of), make(node.key)
        return lambda scope: _item(of(scope), key(scope))
    if isinstance(node, Not):
        of = make(node.of)
        return lambda scope: not of(scope)
    if isinstance(node, Choice):
        test, yes, no = make(node.test), make(node.yes), make(node.no)
        return lambda scope: yes(scope) if test(scope) else no(scope)
    if isinstance(node, Filter):
        of, act = make(node.of), filters[node.name]
        return lambda scope: act(of(scope))
    left, right = make(node.left), make(node.right)
    if node.op == "and":
        return lambda scope: left(scope) and right(scope)
    if node.op == "or":
        return lambda scope: left(scope) or right(scope)
    act = OPS[node.op]
    return lambda scope: act(left(scope), right(scope))


def _rounds(items: Iterable) -> Iterator[tuple[object, dict]]:
    """Items with what `loop` says about each; one item is looked ahead."""
    if not isinstance(items, list | tuple | Iterator):
        raise TemplateError("only lists can be looped over")
    each, n = iter(items), 0
    now = next(each, each)
    while now is not each:
        following = next(each, each)
        yield now, {"index0": n, "index": n + 1, "first": n == 0, "last": following is each}
        now, n = following, n + 1


def _step(node, known: frozenset, filters: Mapping[str, Callable]) -> Callable[[dict, Sheet], None]:
    if isinstance(node, Write):
        if isinstance(node.value, Const):
            text = node.value.value
            return lambda scope, sheet: sheet.write(text)
        value = _value(node.value, known, filters)
        return lambda scope, sheet: sheet.write(_text(value(scope)))
    if isinstance(node, Set):
        value, name = _value(node.value, known, filters), node.name

        def put(scope, sheet):
            scope[name] = value(scope)

        return put
    if isinstance(node, If):
        test = _value(node.test, known, filters)
        yes, no = _steps(node.yes, known, filters), _steps(node.no, known, filters)
        return lambda scope, sheet: yes(scope, sheet) if test(scope) else no(scope, sheet)
    if isinstance(node, Generation):
        body = _steps(node.body, known, filters)

        def marked(scope, sheet):
            start = sheet.size
            body(scope, sheet)
            sheet.spans.append((start, sheet.size))

        return marked
    each = _loop(node, known, filters)

    def all_rounds(scope, sheet):
        for _ in each(scope, sheet):
            pass

    return all_rounds


def _loop(node: For, known: frozenset, filters: Mapping[str, Callable]) -> Callable[[dict, Sheet], Iterator[None]]:
    """Renders one round each time it is asked."""
    over, name = _value(node.over, known, filters), node.name
    body = _steps(node.body, known | {name, "loop"}, filters)

    def rounds(scope, sheet):
        for item, loop in _rounds(over(scope)):
            body({**scope, name: item, "loop": loop}, sheet)
            yield

    return rounds


def _steps(nodes: tuple, known: frozenset, filters: Mapping[str, Callable]) -> Callable[[dict, Sheet], None]:
    steps = []
    for node in nodes:
        steps.append(_step(node, known, filters))
        if isinstance(node, Set):
            known = known | {node.name}
    if len(steps) == 1:
        return steps[0]

    def run(scope, sheet):
        for step in steps:
            step(scope, sheet)

    return run


@dataclass(frozen=True)
class Template:
    """A compiled template."""

    tree: tuple
    steps: tuple  # (is a loop, closure) of each node at the top

    def stream(self, **given) -> Iterator[Sheet]:
        """The sheet that is written to, after each node and after each round of
        a loop at the top. Take from it whenever enough has been written."""
        scope, sheet = dict(given), Sheet()
        for loops, step in self.steps:
            if loops:
                for _ in step(scope, sheet):
                    yield sheet
            else:
                step(scope, sheet)
            yield sheet

    def render(self, **given) -> tuple[str, list[tuple[int, int]]]:
        """All at once: the text, and the spans marked for generation."""
        sheet = Sheet()
        for sheet in self.stream(**given):
            pass
        return sheet.take()


def compile_template(
    source: str, names: Iterable[str] = ("messages",), constants: Mapping[str, object] | None = None,
    filters: Mapping[str, Callable] | None = None,
) -> Template:
    """`names` are given at rendering; `constants` are known now."""
    filters = {"trim": lambda x: _text(x).strip(), **(filters or {})}
    tree = parse(source)
    constants = {k: v for k, v in (constants or {}).items() if k not in _assigned(tree)}
    tree = fold_all(tree, constants, filters)
    known, steps = frozenset(names), []
    for node in tree:
        loops = isinstance(node, For)
        steps.append((loops, (_loop if loops else _step)(node, known, filters)))
        if isinstance(node, Set):
            known = known | {node.name}
    return Template(tree, tuple(steps))
