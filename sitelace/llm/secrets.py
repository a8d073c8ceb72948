"""Secret scans by a trigram inverted index, in DataFrame functions alone.

A Boolean trigram query is derived from each rule's regular expression: the strings that every match must hold, as a
conjunction of alternatives, each alternative a set of trigrams.  A text's lines are the indexed units (no rule matches
across a line end).  One pass over a lowered line takes out its own trigrams, as far as any rule asks for them; turned
about they are the postings, a map from trigram to line numbers (`postings`), which is made once for all rules.  By it
alternatives intersect their lists, clauses unite and then intersect, and only lines that remain are verified by the regular
expression.  A rule without mandatory trigrams scans all lines.  Postings never leave their row, so the index costs no
shuffle and no text moves.

The expressions are written as SQL text, which Spark parses once; called function by function they took seconds to build.
No pattern repeats a group, so that Java's matcher does not recurse, and none can begin anew within a run that it has
failed on, so that time is linear in a line's length.

A span is (kind, start, end) in code points of the text, end exclusive, sorted by start, then kind as in RULES.

Cases: a null or empty text has no spans; matches of one rule do not overlap, those of several may; very long texts and
lines are scanned whole; equal rows have equal spans; an empty table gives an empty result.  The operator is a column
expression: other columns are not touched.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from itertools import count, product
from re import _constants as sre
from re import _parser

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """group: what of a match must have `least` characters (0 the match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Base rules come first.  `hex` and `access` say their least length in the pattern, which leaves the same matches.
RULES = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
    Rule("private_key", r"-----BEGIN [A-Z0-9 ]*+(?<= PRIVATE KEY)-----"),
    Rule("source_host", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("chat_host", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{4,}"),
)
BASE = 3
MOST_STRINGS = 64
Clause = list[frozenset[str]]


def _strings(node) -> list[str] | None:
    """The strings that a piece of a pattern stands for, if few; else None."""
    op, arg = node
    if op is sre.LITERAL:
        return [chr(arg).lower()]
    if op is sre.IN:
        out: list[str] = []
        for kind, x in arg:
            if kind is sre.LITERAL:
                out.append(chr(x).lower())
            elif kind is sre.RANGE and x[1] - x[0] < 8:
                out += [chr(c).lower() for c in range(x[0], x[1] + 1)]
            else:
                return None
        return list(dict.fromkeys(out)) if len(out) <= 8 else None
    if op is sre.SUBPATTERN:
        return _sequence(list(arg[3]))
    if op is sre.BRANCH:
        parts = [_sequence(list(x)) for x in arg[1]]
        return None if None in parts else [s for p in parts for s in p]
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT, sre.POSSESSIVE_REPEAT):
        low, high, body = arg
        inner = _sequence(list(body))
        if inner is None or high > 4:
            return None
        return ["".join(x) for k in range(low, high + 1) for x in product(inner, repeat=k)] if len(inner) ** high <= MOST_STRINGS else None
    return None


def _sequence(nodes: list) -> list[str] | None:
    out = [""]
    for node in nodes:
        more = _strings(node)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = [a + b for a in out for b in more]
    return out


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[i : i + 3] for i in range(len(text) - 2))


def trigram_query(pattern: str) -> list[Clause]:
    """Clauses that all must hold; of a clause one alternative, and of that all trigrams.  Letters are lowered."""
    clauses: list[Clause] = []
    run = [""]

    def close() -> None:
        nonlocal run
        sets = list(dict.fromkeys(trigrams(s) for s in run))
        if all(sets):  # an alternative that asks for more than another adds nothing
            clauses.append([s for s in sets if not any(o < s for o in sets)])
        run = [""]

    def walk(nodes: list) -> None:
        nonlocal run
        for node in nodes:
            more = _strings(node)
            if more is not None and len(run) * len(more) <= MOST_STRINGS:
                run = [a + b for a in run for b in more]
                continue
            close()
            if more is not None:
                run = more
            elif node[0] is sre.SUBPATTERN:
                walk(list(node[1][3]))
                close()
            elif node[0] in (sre.MAX_REPEAT, sre.POSSESSIVE_REPEAT) and node[1][0] > 0:
                walk(list(node[1][2]))
                close()
            elif node[0] is sre.ASSERT:
                walk(list(node[1][1]))
                close()

    walk(list(_parser.parse(pattern)))
    close()
    return clauses


def _text(said: str) -> str:
    """A pattern or string as an SQL literal without escapes."""
    return "r'" + said.replace("'", r"\x27") + "'"


_names = count()


def let(value: str, body: Callable[[str], str]) -> str:
    """SQL for `body` of a name for the value, which is computed once."""
    name = f"v{next(_names)}"
    return f"get(transform(array({value}), {name} -> {body(name)}), 0)"


def prefix_sums(numbers: str) -> str:
    """SQL for the sums up to and with each element, in blocks as long as the cube root, so that long arrays cost little more than their length."""
    total = lambda x: f"aggregate({x}, 0, (a, x) -> a + x)"

    def of(n: str) -> str:
        def by_block(size: str) -> str:
            sums = f"transform(sequence(0, cast((size({n}) - 1) div {size} as int)), b -> {total(f'slice({n}, b * {size} + 1, {size})')})"

            def spread(s: str) -> str:
                block = lambda before: let(f"slice({n}, b * {size} + 1, {size})", lambda q: f"transform({q}, (x, j) -> {before} + {total(f'slice({q}, 1, j + 1)')})")
                return f"flatten(transform({s}, (x, b) -> {let(total(f'slice({s}, 1, b)'), block)}))"

            return let(sums, spread)

        return f"if(size({n}) = 0, cast(array() as array<int>), {let(f'greatest(8, cast(ceil(cbrt(size({n}))) as int))', by_block)})"

    return let(numbers, of)


SPANS = "array<struct<start:int,rank:int,end:int,kind:string>>"
NONE, NO_SPANS = "cast(array() as array<int>)", f"cast(array() as {SPANS})"


def vocabulary(rules: tuple[Rule, ...]) -> list[str]:
    """The trigrams that any rule asks for."""
    return sorted({g for r in rules for clause in trigram_query(r.pattern) for grams in clause for g in grams})


def overlapping(grams: list[str]) -> str:
    """A pattern that finds them all, those within others too; alternatives with one first letter stand together."""
    by_first: dict[str, list[str]] = {}
    for g in grams:
        by_first.setdefault(g[0], []).append(re.escape(g[1:]))
    return "(?=(" + "|".join(f"{re.escape(c)}(?:{'|'.join(more)})" for c, more in by_first.items()) + "))"


def postings_sql(lines: str, rules: tuple[Rule, ...]) -> str:
    """SQL for the inverted index of an array of lines: map from trigram to the numbers of the lines that hold it."""
    own = f"array_distinct(regexp_extract_all(lower(x), {_text(overlapping(vocabulary(rules)))}, 1))"
    pairs = f"flatten(transform({lines}, (x, i) -> transform({own}, g -> named_struct('g', g, 'i', i))))"

    def inverted(e: str) -> str:
        return let(f"array_distinct(transform({e}, x -> x.g))", lambda d: f"map_from_arrays({d}, transform({d}, g -> transform(filter({e}, x -> x.g = g), x -> x.i)))")

    return let(pairs, inverted)


def postings(text: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """Of a column of texts, by name: the index of each, to be kept or looked at."""
    return F.expr(let(f"split(coalesce(`{text}`, ''), '\n')", lambda lines: postings_sql(lines, rules)))


def _candidates(lines: str, index: str, rule: Rule) -> str:
    """SQL for the numbers of the lines that a rule's pattern must look at."""
    clauses = trigram_query(rule.pattern)
    if not clauses:
        return f"filter(sequence(0, size({lines}) - 1), i -> rlike(get({lines}, i), {_text(rule.pattern)}))"

    def intersected(lists: list[str]) -> str:
        out = lists[0]
        for more in lists[1:]:
            out = f"array_intersect({out}, {more})"
        return out

    def alternative(grams: frozenset[str]) -> str:
        return intersected([f"coalesce(try_element_at({index}, {_text(g)}), {NONE})" for g in sorted(grams)])

    def clause(alternatives: Clause) -> str:
        out = alternative(alternatives[0])
        for grams in alternatives[1:]:
            out = f"array_union({out}, {alternative(grams)})"
        return out

    return f"sort_array({intersected([clause(c) for c in clauses])})"


def _matches(line: str, at: str, rule: Rule, rank: int) -> str:
    """SQL for the spans of a rule in a line that starts at a place of the text: what lies between matches, and the matches, have all lengths."""
    pattern = _text(rule.pattern)

    def placed(f: str) -> str:
        def of(b: str) -> str:
            steps = f"transform({f}, (x, i) -> length(get({b}, i)) + if(i = 0, 0, length(get({f}, i - 1))))"

            def kept(s: str) -> str:
                start = f"{at} + get({s}, i)"
                spans = f"transform({f}, (x, i) -> named_struct('start', {start}, 'rank', {rank}, 'end', {start} + length(x), 'kind', '{rule.kind}'))"
                held = f"regexp_extract_all({line}, {pattern}, {rule.group})" if rule.group else f
                return spans if rule.least < 2 else let(held, lambda g: f"filter({spans}, (x, i) -> length(get({g}, i)) >= {rule.least})")

            return let(prefix_sums(steps), kept)

        return f"if(size({f}) = 0, {NO_SPANS}, {let(f'split({line}, {pattern}, -1)', of)})"

    return let(f"regexp_extract_all({line}, {pattern}, 0)", placed)


def secret_spans(text: str, rules: tuple[Rule, ...] = RULES) -> Column:
    """Of a column of texts, by name: array of struct(start, rank, end, kind), by start, then rank."""

    def of(lines: str) -> str:
        def looked_at(index: str) -> str:
            return "named_struct(" + ", ".join(f"'r{n}', {_candidates(lines, index, r)}" for n, r in enumerate(rules)) + ")"

        def found(c: str) -> str:
            def spans(ends: str) -> str:
                begin = f"if(i = 0, 0, get({ends}, i - 1))"
                by_rule = (f"flatten(transform({c}.r{n}, i -> {let(f'get({lines}, i)', lambda x, n=n, r=r: let(begin, lambda at: _matches(x, at, r, n)))}))" for n, r in enumerate(rules))
                return f"sort_array(flatten(array({', '.join(by_rule)})))"

            some = " or ".join(f"size({c}.r{n}) > 0" for n in range(len(rules)))
            return f"if({some}, {let(prefix_sums(f'transform({lines}, x -> length(x) + 1)'), spans)}, {NO_SPANS})"

        return let(let(postings_sql(lines, rules), looked_at), found)

    return F.expr(let(f"split(coalesce(`{text}`, ''), '\n')", of))
