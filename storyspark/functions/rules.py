"""Turn ordered (pattern, label) rule lists into single Column expressions."""

from __future__ import annotations

from functools import lru_cache, reduce
from operator import or_
from re import _constants as _op, _parser, escape

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text(c) -> Column:
    """The column with NULL read as the empty string."""
    return F.coalesce(col(c), F.lit(""))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it in ``body``, also inside array lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def folded(c) -> Column:
    """Lower case, with the letters that a case-insensitive pattern takes for ASCII ones replaced by them."""
    t = text(c)
    for letter, plain in (("\u0130", "i"), ("\u0131", "i"), ("\u017f", "s"), ("\u212a", "k")):
        t = F.replace(t, F.lit(letter), F.lit(plain))
    return F.lower(t)


def _literals(items) -> tuple[str, ...]:
    """Lower-case ASCII literals of which every match holds at least one; () when there are none."""
    found, run = [], ""
    for kind, arg in items:
        if kind is _op.LITERAL and arg < 128:
            run += chr(arg).lower()
            continue
        if kind in (_op.AT, _op.ASSERT, _op.ASSERT_NOT):
            continue
        found, run = found + [(run,)], ""
        if kind is _op.SUBPATTERN:
            found.append(_literals(arg[3]))
        elif kind is _op.BRANCH:
            parts = [_literals(b) for b in arg[1]]
            found.append(sum(parts, ()) if all(parts) else ())
        elif kind in (_op.MAX_REPEAT, _op.MIN_REPEAT) and arg[0] > 0:
            found.append(_literals(arg[2]))
    options = [f for f in [*found, (run,)] if f and all(f)]
    return max(options, key=lambda f: min(map(len, f)), default=())


@lru_cache(maxsize=None)
def needles(pattern: str) -> tuple[str, ...]:
    """Literals of two or more letters of which every match of ``pattern`` holds one, in ``folded`` form."""
    every = sorted(set(_literals(_parser.parse(pattern))), key=len)
    kept = [n for i, n in enumerate(every) if not any(m in n for m in every[:i])]
    return tuple(kept) if kept and len(kept[0]) > 1 else ()


def _tree(words) -> str:
    """A pattern for any of the words, with common beginnings written once."""
    if "" in words:
        return ""
    by_first: dict[str, list[str]] = {}
    for w in words:
        by_first.setdefault(w[0], []).append(w[1:])
    parts = [escape(c) + _tree(rest) for c, rest in sorted(by_first.items())]
    return parts[0] if len(parts) == 1 else f"(?:{'|'.join(parts)})"


def may_hit(low: Column, patterns, phrases=()) -> Column:
    """False only where no pattern can match and no lower-case phrase occurs, from one search of the ``folded`` text."""
    wanted = [needles(p) for p in patterns]
    every = {*sum(wanted, ()), *phrases}
    least = [w for w in every if not any(v != w and v in w for v in every)]
    return low.rlike(_tree(least)) if all(wanted) else F.lit(True)


def _search(c, pattern: str, flags: str, low: Column | None) -> Column:
    """Regex search; with ``low`` (``folded``) only where a literal of the pattern occurs, which is much faster."""
    found = text(c).rlike(flags + pattern)
    wanted = () if low is None else needles(pattern)
    return contains_any(low, wanted) & found if wanted else found


def hits(c, pattern: str, low: Column | None = None) -> Column:
    """Case-insensitive, Unicode-aware regex search."""
    return _search(c, pattern, "(?iU)", low)


def hits_cs(c, pattern: str, low: Column | None = None) -> Column:
    """Case-sensitive regex search."""
    return _search(c, pattern, "(?U)", low)


def screened(c, body) -> Column:
    """``body`` of a text and its ``folded`` form, each evaluated once."""
    return let(F.struct(text(c).alias("t"), folded(c).alias("low")), lambda v: body(v["t"], v["low"]))


def first_label(c, rules, default=None) -> Column:
    """Label of the first matching (pattern, label) rule."""
    def ladder(t, low):
        out = F
        for pattern, label in rules:
            out = out.when(hits(t, pattern, low), F.lit(label))
        return out.otherwise(F.lit(default)) if default is not None else out

    return screened(c, ladder)


def all_labels(c, rules) -> Column:
    """Sorted labels of every matching rule."""
    return screened(c, lambda t, low: F.array_sort(F.array_distinct(F.array_compact(
        F.array(*[F.when(hits(t, p, low), F.lit(label)) for p, label in rules])))))


def contains_any(c, phrases) -> Column:
    """True when any literal phrase occurs in the (already lower-cased) column."""
    return F.coalesce(reduce(or_, [F.contains(col(c), F.lit(p)) for p in phrases]), F.lit(False))


def in_list(c, values) -> Column:
    return F.coalesce(col(c).isin(list(values)), F.lit(False))


def str_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def literal_map(values: dict, value_type: str) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.create_map(*pairs).cast(f"map<string,{value_type}>")
