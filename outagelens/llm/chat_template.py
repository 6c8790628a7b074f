"""Chat formatting by compiled templates.

A template is parsed into a syntax tree, constant parts are folded, and the rest becomes nested
Python closures. The language is a sandbox: it reads the names it is given, keys of mappings,
and the filters below; it calls nothing, and there is no way to Python's own attributes.

    {{ expression }}                     put out text
    {% for x in list %} ... {% endfor %} with loop.index, loop.index0, loop.first, loop.last
    {% if a %} ... {% elif b %} ... {% else %} ... {% endif %}
    {% set name = expression %}
    {% generation %} ... {% endgeneration %}   what the model is to learn; its place is recorded
    {# comment #}

Expressions have texts, whole numbers, true, false, none, names, ``a.b``, ``a['b']``, ``==``,
``!=``, ``<``, ``<=``, ``>``, ``>=``, ``in``, ``+``, ``-``, ``%``, ``~`` (joins as text), ``not``,
``and``, ``or``, parentheses and filters (``x | trim``).
"""

from __future__ import annotations

import hashlib
import operator
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class TemplateError(ValueError):
    """The template can't be parsed, or reads something it must not."""


# --- Syntax tree -------------------------------------------------------------------------


@dataclass(frozen=True)
class Const:
    value: object


@dataclass(frozen=True)
class Name:
    name: str


@dataclass(frozen=True)
class Key:
    of: object
    key: object


@dataclass(frozen=True)
class Apply:
    """An operator or filter on its arguments."""

    name: str
    args: tuple


@dataclass(frozen=True)
class Logic:
    name: str  # and, or
    left: object
    right: object


@dataclass(frozen=True)
class Put:
    value: object


@dataclass(frozen=True)
class Let:
    name: str
    value: object


@dataclass(frozen=True)
class Block:
    parts: tuple


@dataclass(frozen=True)
class Loop:
    name: str
    over: object
    body: Block


@dataclass(frozen=True)
class Choice:
    """Pairs of condition and block; the first that holds is taken."""

    cases: tuple


@dataclass(frozen=True)
class Generation:
    body: Block


# --- Escaping ------------------------------------------------------------------------------


_CONTROL = re.compile(r"[\\<]")
_ESCAPED = re.compile(r"\\(.)", re.DOTALL)


def escape(text: str) -> str:
    """A backslash before each backslash and ``<``: no control string of a template that starts with ``<`` remains."""
    return _CONTROL.sub(r"\\\g<0>", text)


def unescape(text: str) -> str:
    return _ESCAPED.sub(r"\1", text)


def _text(value: object) -> str:
    if value is None:
        return ""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)


def _remainder(a: object, b: object) -> int:
    """Of numbers only: of texts, % would format and could make any length."""
    if type(a) is not int or type(b) is not int or b == 0:
        raise TemplateError("% needs whole numbers, the second not zero")
    return a % b


_OPERATORS: dict[str, Callable] = {
    "==": operator.eq,
    "!=": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
    "+": operator.add,
    "-": operator.sub,
    "%": lambda a, b: _remainder(a, b),
    "~": lambda a, b: _text(a) + _text(b),
    "in": lambda a, b: a in b,
    "not": operator.not_,
    "|escape": lambda x: escape(_text(x)),
    "|trim": lambda x: _text(x).strip(),
    "|upper": lambda x: _text(x).upper(),
    "|lower": lambda x: _text(x).lower(),
    "|length": len,
}


def _checked(call: Callable) -> Callable:
    """Values that an operator can't take are the template's fault."""

    def apply(*values: object) -> object:
        try:
            return call(*values)
        except TypeError as error:
            raise TemplateError(str(error)) from None

    return apply


# --- Parser -------------------------------------------------------------------------------------


_QUOTED = r"""'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*\""""
_PARTS = re.compile(rf"(\{{\{{(?:{_QUOTED}|[^'\"])*?\}}\}}|\{{%(?:{_QUOTED}|[^'\"])*?%\}}|\{{#.*?#\}})", re.DOTALL)
#: Most expressions inside each other, and words and marks of one expression.
DEPTH, LENGTH = 60, 300
_TOKENS = re.compile(
    r"""\s*(?:(?P<text>'(?:[^'\\]|\\.)*'|"(?:[^"\\]|\\.)*")|(?P<number>\d+)|(?P<name>[A-Za-z_]\w*)|(?P<mark>==|!=|<=|>=|[<>+\-%~|.()\[\]=]))""",
    re.DOTALL,
)
_WORDS = {"true": True, "false": False, "none": None}
_ESCAPES = {"n": "\n", "t": "\t"}


class _Expression:
    """Recursive descent over one expression."""

    def __init__(self, source: str):
        self.tokens: list[tuple[str, str]] = []
        at, source = 0, source.rstrip()
        while at < len(source):
            found = _TOKENS.match(source, at)
            if not found:
                raise TemplateError(f"can't read {source[at:]!r}")
            self.tokens.append((found.lastgroup, found[found.lastgroup]))
            at = found.end()
        if len(self.tokens) > LENGTH:
            raise TemplateError(f"an expression of more than {LENGTH} words and marks")
        self.at = 0
        self.depth = 0

    def deeper(self, rule: Callable[[], object]) -> object:
        self.depth += 1
        if self.depth > DEPTH:
            raise TemplateError(f"more than {DEPTH} expressions inside each other")
        value = rule()
        self.depth -= 1
        return value

    def peek(self) -> str:
        return self.tokens[self.at][1] if self.at < len(self.tokens) and self.tokens[self.at][0] != "text" else ""

    def take(self, kind: str | None = None) -> str:
        if self.at >= len(self.tokens) or kind and self.tokens[self.at][0] != kind:
            raise TemplateError(f"{kind or 'more'} expected")
        self.at += 1
        return self.tokens[self.at - 1][1]

    def expect(self, mark: str) -> None:
        if self.take() != mark:
            raise TemplateError(f"{mark!r} expected")

    def whole(self) -> object:
        value = self.either()
        if self.at < len(self.tokens):
            raise TemplateError(f"{self.tokens[self.at][1]!r} is too much")
        return value

    def either(self) -> object:
        value = self.both()
        while self.peek() == "or":
            self.take()
            value = Logic("or", value, self.both())
        return value

    def both(self) -> object:
        value = self.negated()
        while self.peek() == "and":
            self.take()
            value = Logic("and", value, self.negated())
        return value

    def negated(self) -> object:
        if self.peek() == "not":
            self.take()
            return Apply("not", (self.deeper(self.negated),))
        value = self.sum()
        while self.peek() in ("==", "!=", "<", "<=", ">", ">=", "in"):
            value = Apply(self.take(), (value, self.sum()))
        return value

    def sum(self) -> object:
        value = self.filtered()
        while self.peek() in ("+", "-", "%", "~"):
            value = Apply(self.take(), (value, self.filtered()))
        return value

    def filtered(self) -> object:
        value = self.atom()
        while self.peek() == "|":
            self.take()
            name = "|" + self.take("name")
            if name not in _OPERATORS:
                raise TemplateError(f"no filter {name[1:]!r}")
            value = Apply(name, (value,))
        return value

    def atom(self) -> object:
        if self.at >= len(self.tokens):
            raise TemplateError("an expression is expected")
        kind, token = self.tokens[self.at]
        self.at += 1
        if kind == "text":
            value: object = Const(re.sub(r"\\(.)", lambda m: _ESCAPES.get(m[1], m[1]), token[1:-1], flags=re.DOTALL))
        elif kind == "number":
            value = Const(int(token))
        elif kind == "name":
            value = Const(_WORDS[token]) if token in _WORDS else Name(token)
        elif token == "(":
            value = self.deeper(self.either)
            self.expect(")")
        else:
            raise TemplateError(f"{token!r} is out of place")
        while self.peek() in (".", "["):
            if self.take() == ".":
                value = Key(value, Const(self.take("name")))
            else:
                value = Key(value, self.deeper(self.either))
                self.expect("]")
        return value


def parse(source: str) -> Block:
    """The syntax tree of a template."""
    parts = [x for x in _PARTS.split(source) if x and not x.startswith("{#")]
    for part in parts:
        if "{{" in part and not part.startswith(("{{", "{%")) or part.startswith(("{{", "{%")) and not part.endswith(("}}", "%}")):
            raise TemplateError(f"can't read {part[:80]!r}")
    block, left = _block(parts, 0, ())
    if left < len(parts):
        raise TemplateError(f"{parts[left]!r} is out of place")
    return block


def _tag(part: str) -> tuple[str, str]:
    words = part[2:-2].strip().split(None, 1) if part.startswith("{%") else []
    return (words[0], words[1] if len(words) > 1 else "") if words else ("", "")


def _block(parts: list[str], at: int, ends: tuple[str, ...]) -> tuple[Block, int]:
    """Parts up to one of the tags in ``ends``, and where that stands."""
    found: list[object] = []
    while at < len(parts):
        part = parts[at]
        tag, rest = _tag(part)
        if tag in ends and tag:
            return Block(tuple(found)), at
        if part.startswith("{{"):
            found.append(Put(_Expression(part[2:-2]).whole()))
        elif not part.startswith("{%"):
            found.append(Put(Const(part)))
        elif tag == "for":
            match = re.fullmatch(r"([A-Za-z_]\w*)\s+in\s+(.*)", rest, re.DOTALL)
            if not match:
                raise TemplateError(f"can't read {part!r}")
            body, at = _block(parts, at + 1, ("endfor",))
            _closed(parts, at, "endfor")
            found.append(Loop(match[1], _Expression(match[2]).whole(), body))
        elif tag == "if":
            cases = []
            condition: object = _Expression(rest).whole()
            while True:
                body, at = _block(parts, at + 1, ("elif", "else", "endif"))
                cases.append((condition, body))
                _closed(parts, at, "endif")
                tag, rest = _tag(parts[at])
                if tag == "endif":
                    break
                condition = _Expression(rest).whole() if tag == "elif" else Const(True)
            found.append(Choice(tuple(cases)))
        elif tag == "set":
            match = re.fullmatch(r"([A-Za-z_]\w*)\s*=(.*)", rest, re.DOTALL)
            if not match:
                raise TemplateError(f"can't read {part!r}")
            found.append(Let(match[1], _Expression(match[2]).whole()))
        elif tag == "generation":
            body, at = _block(parts, at + 1, ("endgeneration",))
            _closed(parts, at, "endgeneration")
            found.append(Generation(body))
        else:
            raise TemplateError(f"{part!r} is out of place")
        at += 1
    return Block(tuple(found)), at


def _closed(parts: list[str], at: int, end: str) -> None:
    if at >= len(parts):
        raise TemplateError(f"{end} is missing")


# --- Constant folding -------------------------------------------------------------------------------


def fold(node: object) -> object:
    """The same tree with constant expressions worked out, neighbouring texts joined, and cases that can't hold left out."""
    match node:
        case Apply(name, args):
            args = tuple(map(fold, args))
            if all(isinstance(x, Const) for x in args):
                try:
                    return Const(_checked(_OPERATORS[name])(*(x.value for x in args)))
                except (TypeError, ZeroDivisionError) as error:
                    raise TemplateError(str(error)) from error
            return Apply(name, args)
        case Logic(name, left, right):
            left, right = fold(left), fold(right)
            if isinstance(left, Const):
                return right if bool(left.value) == (name == "and") else left
            return Logic(name, left, right)
        case Key(of, key):
            return Key(fold(of), fold(key))
        case Put(value):
            value = fold(value)
            return Put(Const(_text(value.value)) if isinstance(value, Const) else value)
        case Let(name, value):
            return Let(name, fold(value))
        case Loop(name, over, body):
            return Loop(name, fold(over), fold(body))
        case Generation(body):
            return Generation(fold(body))
        case Choice(cases):
            left = []
            for condition, body in cases:
                condition = fold(condition)
                if isinstance(condition, Const) and not condition.value:
                    continue
                left.append((condition, fold(body)))
                if isinstance(condition, Const):
                    break
            if not left:
                return Block(())
            return left[0][1] if isinstance(left[0][0], Const) else Choice(tuple(left))
        case Block(parts):
            found: list[object] = []
            for part in map(fold, parts):
                for one in part.parts if isinstance(part, Block) else (part,):
                    last = found[-1] if found else None
                    if isinstance(one, Put) and isinstance(one.value, Const):
                        if not one.value.value:
                            continue
                        if isinstance(last, Put) and isinstance(last.value, Const):
                            found[-1] = Put(Const(last.value.value + one.value.value))
                            continue
                    found.append(one)
            return Block(tuple(found))
    return node


# --- Closures ------------------------------------------------------------------------------------------


class _Out:
    """What has been put out, its length in code points, and the places under generation markers."""

    def __init__(self):
        self.pieces: list[str] = []
        self.length = 0
        self.spans: list[tuple[int, int]] = []

    def put(self, text: str) -> None:
        self.pieces.append(text)
        self.length += len(text)


def _value(node: object) -> Callable[[dict], object]:
    match node:
        case Const(value):
            return lambda scope: value
        case Name(name):
            return lambda scope: scope.get(name)
        case Key(of, key):
            get_of, get_key = _value(of), _value(key)

            def read(scope: dict) -> object:
                holder, name = get_of(scope), get_key(scope)
                if isinstance(holder, dict):
                    return holder.get(name)
                if isinstance(holder, (list, tuple)) and isinstance(name, int):
                    return holder[name] if -len(holder) <= name < len(holder) else None
                raise TemplateError(f"{name!r} can't be read here")

            return read
        case Logic(name, left, right):
            get_left, get_right = _value(left), _value(right)
            if name == "and":
                return lambda scope: get_left(scope) and get_right(scope)
            return lambda scope: get_left(scope) or get_right(scope)
        case Apply(name, args):
            call, gets = _checked(_OPERATORS[name]), [_value(x) for x in args]
            if len(gets) == 1:
                get = gets[0]
                return lambda scope: call(get(scope))
            first, second = gets
            return lambda scope: call(first(scope), second(scope))
    raise TemplateError(f"{node!r} is no expression")


def _action(node: object) -> Callable[[dict, _Out], None]:
    match node:
        case Put(Const(value)):
            return lambda scope, out: out.put(value)
        case Put(value):
            get = _value(value)
            return lambda scope, out: out.put(_text(get(scope)))
        case Let(name, value):
            get_value = _value(value)

            def let(scope: dict, out: _Out) -> None:
                scope[name] = get_value(scope)

            return let
        case Block(parts):
            actions = [_action(part) for part in parts]

            def run(scope: dict, out: _Out) -> None:
                for action in actions:
                    action(scope, out)

            return run
        case Loop(name, over, body):
            get_items, run_body = _value(over), _action(body)

            def loop(scope: dict, out: _Out) -> None:
                items = get_items(scope) or ()
                if not isinstance(items, (list, tuple)):
                    raise TemplateError(f"{name!r} can't run over {type(items).__name__}")
                last = len(items) - 1
                for i, item in enumerate(items):
                    place = {"index0": i, "index": i + 1, "first": i == 0, "last": i == last}
                    run_body({**scope, name: item, "loop": place}, out)

            return loop
        case Choice(cases):
            made = [(_value(condition), _action(body)) for condition, body in cases]

            def choose(scope: dict, out: _Out) -> None:
                for holds, action in made:
                    if holds(scope):
                        return action(scope, out)

            return choose
        case Generation(body):
            run_inner = _action(body)

            def generation(scope: dict, out: _Out) -> None:
                start = out.length
                run_inner(scope, out)
                out.spans.append((start, out.length))

            return generation
    raise TemplateError(f"{node!r} can't be run")


class Template:
    """A compiled template."""

    def __init__(self, source: str):
        self.source = source
        self.tree = fold(parse(source))
        self._run = _action(self.tree)

    def render(self, **names: object) -> tuple[str, list[tuple[int, int]]]:
        """The text, and the places (in code points) of what generation markers enclose."""
        out = _Out()
        self._run(dict(names), out)
        return "".join(out.pieces), out.spans


# --- Conversations -----------------------------------------------------------------------------------------


#: Every turn is marked; role and text are escaped; assistants' texts are what is to be learned.
TURN_TEMPLATE = (
    "{% for m in messages %}<turn>{{ m.role | escape }}<text>"
    "{% if m.role == 'assistant' %}{% generation %}{{ m.text | escape }}{% endgeneration %}"
    "{% else %}{{ m.text | escape }}{% endif %}</turn>\n{% endfor %}"
)
_INNER = r"([^\\<]*(?:\\.[^\\<]*)*)"
_TURN = re.compile(f"<turn>{_INNER}<text>{_INNER}</turn>\n", re.DOTALL)


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Role and text of each turn, read back from what `TURN_TEMPLATE` put out."""
    turns, at = [], 0
    while at < len(formatted):
        found = _TURN.match(formatted, at)
        if not found:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(found[1]), unescape(found[2])))
        at = found.end()
    return turns


def conversations_of(rows: DataFrame) -> DataFrame:
    """conv_id, messages: the turns of each conversation in order.

    A conversation becomes one text, so its turns must fit one row; that is the only bound.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("messages"))


def render_column(source: str = TURN_TEMPLATE) -> Callable[[Column], Column]:
    """Messages to (formatted, spans): the text and the places of the loss mask in code points."""

    @F.pandas_udf("formatted string, spans array<struct<start: int, end: int>>")
    def render(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        template = Template(source)
        for conversations in batches:
            rows = []
            for messages in conversations:
                text, spans = template.render(messages=[dict(m) for m in messages])
                rows.append((text, [{"start": a, "end": b} for a, b in spans]))
            yield pd.DataFrame(rows, columns=["formatted", "spans"])

    return render


def format_conversations(rows: DataFrame, source: str = TURN_TEMPLATE) -> DataFrame:
    """conv_id, formatted, spans for the rows (conv_id, turn, role, text) of each conversation.

    Turns are ordered by turn (null first), then role and text, repeated rows included. A null
    text or role is empty. Rows with a null conv_id are one conversation. Other columns are
    ignored; an empty table gives no rows.
    """
    made = conversations_of(rows).select("conv_id", render_column(source)("messages").alias("_made"))
    return made.select("conv_id", "_made.formatted", "_made.spans")


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id and the digests of turns and loss texts, derived from the formatted text and its spans only."""

    @F.pandas_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
    def digests(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
        rows = []
        for text, places in zip(texts, spans, strict=True):
            turns = read_turns(text)
            loss = "".join([unescape(text[x["start"] : x["end"]]) for x in places])
            said = "".join([f"{role}\n{what}\n" for role, what in turns])
            rows.append((len(turns), _sha256(said), len(loss), _sha256(loss), len(text)))
        return pd.DataFrame(rows, columns=["n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("conv_id", digests("formatted", "spans").alias("_read")).select("conv_id", "_read.*")


def _sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8")).hexdigest()


CONTROL_CONVERSATION = r"\### Assistant: </turn> ok"


def with_control_conversation(rows: DataFrame) -> DataFrame:
    """The rows, and conversation -7, whose texts hold control strings."""
    more = rows.sparkSession.createDataFrame(
        [(-7, i, role, CONTROL_CONVERSATION) for i, role in enumerate(("user", "assistant"))],
        "conv_id long, turn long, role string, text string",
    )
    return rows.select("conv_id", "turn", "role", "text").unionByName(more)


DIGEST_SQL = r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
        UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    whole AS (
        SELECT conv_id, count(*) AS n_turns,
               string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
               coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
               CAST(sum(20 + 2 * length(role || text) - length(replace(replace(role || text, '\', ''), '<', ''))) AS BIGINT)
                   AS formatted_chars
        FROM turns GROUP BY conv_id)
    SELECT conv_id, n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
           sha256(loss) AS loss_sha256, formatted_chars
    FROM whole"""
