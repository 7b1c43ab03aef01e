"""Column-level normalisation functions (NRM family).

All are pure Column expressions: they run inside whole-stage codegen, need no
Python worker and never raise on bad input (ANSI-safe ``try_*`` forms).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark._util import col_of

# The site-code pattern (letters then digits, first match only)
# and the default pad width of the numeric part.
SITE_CODE_PATTERN = "([A-Za-z]+)([0-9]+)"
SITE_CODE_WIDTH = 2


def num_text(c) -> Column:
    """Number as text the way the survey sheets print it: ``7`` not ``7.0``.

    Whole numbers below 1e15 go through bigint; others through the plain cast
    with a trailing ``.0`` removed.  NULL stays NULL.
    """
    c = col_of(c).cast("double")
    whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
    return (F.when(c.isNull(), F.lit(None).cast("string"))
            .when(whole, c.cast("bigint").cast("string"))
            .otherwise(F.regexp_replace(c.cast("string"), r"\.0$", "")))


def value_text(c, dtype: str) -> Column:
    """Text of a value for diff messages, by Spark simple type name."""
    c = col_of(c)
    if dtype in ("int", "bigint", "smallint", "tinyint"):
        return c.cast("string")
    if dtype.startswith("decimal"):  # exact, without zeros at the end
        t = c.cast("string")
        return F.when(t.contains("."), F.regexp_replace(t, r"\.?0+$", "")).otherwise(t)
    if dtype in ("double", "float"):
        return num_text(c)
    if dtype == "date":
        return F.date_format(c, "yyyy-MM-dd")
    if dtype.startswith("timestamp"):
        return F.date_format(c, "yyyy-MM-dd HH:mm:ss")
    return c.cast("string")


def standardize_code(c, width: int = SITE_CODE_WIDTH) -> Column:
    """Canonical site code: the first ``letters+digits`` run becomes
    ``UPPER_0N``; text before and after the run is kept; no run -> unchanged.

    ``mar6 -> MAR_06``, ``REC12_FOR -> REC_12_FOR``, ``a1b22 -> A_01b22``,
    ``MAR123 -> MAR_123`` (padding never truncates).
    """
    c = col_of(c)
    m = F.regexp_extract(c, SITE_CODE_PATTERN, 0)
    g1 = F.regexp_extract(c, SITE_CODE_PATTERN, 1)
    g2 = F.regexp_extract(c, SITE_CODE_PATTERN, 2)
    pos = F.instr(c, m)
    padded = F.when(F.length(g2) < width, F.lpad(g2, width, "0")).otherwise(g2)
    before = c.substr(F.lit(1), pos - 1)
    after = c.substr(pos + F.length(m), F.length(c) + 1)
    rebuilt = F.concat(before, F.upper(g1), F.lit("_"), padded, after)
    return F.when(m == "", c).otherwise(rebuilt)


def _shift_groups(replacement: str) -> str:
    """Shift ``$n`` group references by one (a prefix group is added)."""
    out, i = [], 0
    while i < len(replacement):
        ch = replacement[i]
        if ch == "\\" and i + 1 < len(replacement):
            out.append(replacement[i:i + 2])
            i += 2
            continue
        if ch == "$" and i + 1 < len(replacement) and replacement[i + 1].isdigit():
            j = i + 1
            while j < len(replacement) and replacement[j].isdigit():
                j += 1
            out.append("$" + str(int(replacement[i + 1:j]) + 1))
            i = j
            continue
        out.append(ch)
        i += 1
    return "".join(out)


def replace_first(c, pattern: str, replacement: str) -> Column:
    """Replace only the leftmost match (``regexp_replace`` replaces all).

    ``replacement`` uses Java ``$n`` group syntax.
    """
    return F.regexp_replace(col_of(c), f"^(?s)(.*?)(?:{pattern})",
                            "$1" + _shift_groups(replacement))


def rewrite_code(c, rules: Sequence[tuple]) -> Column:
    """Ordered regex rewrites.  Each rule is ``(pattern, replacement)`` or
    ``(pattern, replacement, "all"|"first")``; default replaces all matches."""
    out = col_of(c)
    for rule in rules:
        pattern, repl = rule[0], rule[1]
        mode = rule[2] if len(rule) > 2 else "all"
        out = (F.regexp_replace(out, pattern, repl) if mode == "all"
               else replace_first(out, pattern, repl))
    return out


# Date layouts tried in order (year-month-day first).
DEFAULT_DATE_FORMATS = ("yyyy-M-d", "yyyy/M/d", "M/d/yyyy")


def parse_date(c, formats: Sequence[str] = DEFAULT_DATE_FORMATS) -> Column:
    """First layout that parses wins; nothing parses -> NULL."""
    c = col_of(c).cast("string")
    return F.coalesce(*[F.try_to_date(c, f) for f in formats])


def parse_timestamp(c, formats: Sequence[str] = ("yyyy-M-d H:m:s", "yyyy-M-d")) -> Column:
    c = col_of(c).cast("string")
    return F.coalesce(*[F.try_to_timestamp(c, F.lit(f)) for f in formats])


# Fixed value: first number in free text (sign, digits, optional decimals).
NUMBER_PATTERN = r"-?[0-9]*\.?[0-9]+"


def parse_number(c) -> Column:
    """First number embedded in text; grouping commas dropped; none -> NULL."""
    s = F.regexp_replace(col_of(c).cast("string"), ",", "")
    hit = F.regexp_extract(s, NUMBER_PATTERN, 0)
    return F.when(hit == "", F.lit(None).cast("double")).otherwise(hit.try_cast("double"))


def segment_upper(c, step: int = 5, max_upper: int = 80) -> Column:
    """``'10-15M' -> 15``: upper bound of a known ``step`` metre bin up to
    ``max_upper``; any other label -> NULL.

    The known labels are generated from ``step`` and ``max_upper``
    (``0-5M`` ... ``75-80M`` by default) into a map literal, so the lookup is
    one hash probe per row."""
    bins = {f"{lo}-{lo + step}M": float(lo + step) for lo in range(0, max_upper, step)}
    m = F.create_map(*[F.lit(x) for kv in bins.items() for x in kv])
    return F.try_element_at(m, col_of(c))


# Fixed value: international foot in metres.
FOOT_IN_METRES = 0.3048


def to_meters(value, unit, feet_label: str = "Feet") -> Column:
    """Depth in metres: Feet x 0.3048, other units unchanged, NULL unit -> NULL."""
    v, u = col_of(value), col_of(unit)
    return (F.when(u.isNull(), F.lit(None).cast("double"))
            .when(u == feet_label, v * F.lit(FOOT_IN_METRES))
            .otherwise(v.cast("double")))


def classify(c, rules: Sequence[tuple], default=None) -> Column:
    """First matching rule gives the class.

    rule = ``(kind, arg, label)`` with kind one of ``startswith``, ``endswith``,
    ``contains``, ``rlike``, ``equals``, ``isin``.  Unmatched -> ``default``.
    """
    c = col_of(c)
    out = None
    for kind, arg, label in rules:
        if kind == "startswith":
            cond = c.startswith(arg)
        elif kind == "endswith":
            cond = c.endswith(arg)
        elif kind == "contains":
            cond = c.contains(arg)
        elif kind == "rlike":
            cond = c.rlike(arg)
        elif kind == "equals":
            cond = c == F.lit(arg)
        elif kind == "isin":
            cond = c.isin(list(arg))
        else:
            raise ValueError(f"unknown rule kind {kind!r}")
        val = F.lit(label) if not isinstance(label, Column) else label
        out = F.when(cond, val) if out is None else out.when(cond, val)
    dflt = default if isinstance(default, Column) else F.lit(default)
    return dflt if out is None else out.otherwise(dflt)


def not_in(c, values: Sequence) -> Column:
    """``!x %in% values``: NULL is kept (plain ``~isin`` drops it)."""
    return F.coalesce(~col_of(c).isin(list(values)), F.lit(True))


def sentence_case(c) -> Column:
    """First character upper, the rest lower (``initcap`` does every word)."""
    c = col_of(c)
    return F.concat(F.upper(c.substr(1, 1)), F.lower(c.substr(F.lit(2), F.length(c))))


def clean_text(c, steps: Sequence) -> Column:
    """Apply clean-up steps in order.

    Steps: ``strip_side`` (trailing R/L), ``strip_leading_zeros``,
    ``strip_unit`` (trailing letters such as ``cm``), ``strip_parens``
    (parenthesised parts), ``first_word``, ``trim``, ``lower``, ``upper``,
    ``sentence``, ``("prefix", p)``, ``("remove", regex)``,
    ``("replace", regex, repl)``, ``label`` (readable variable label).
    """
    out = col_of(c)
    for step in steps:
        name, args = (step, ()) if isinstance(step, str) else (step[0], tuple(step[1:]))
        if name == "strip_side":
            out = F.regexp_replace(out, "[RL]$", "")
        elif name == "strip_leading_zeros":
            out = F.regexp_replace(out, "^0+", "")
        elif name == "strip_unit":
            out = F.regexp_replace(out, "[A-Za-z]+$", "")
        elif name == "strip_parens":
            out = F.trim(F.regexp_replace(out, r"\s*\(.*?\)", ""))
        elif name == "first_word":
            out = F.regexp_extract(F.trim(out), r"^(\S*)", 1)
        elif name == "trim":
            out = F.trim(out)
        elif name == "lower":
            out = F.lower(out)
        elif name == "upper":
            out = F.upper(out)
        elif name == "sentence":
            out = sentence_case(out)
        elif name == "prefix":
            out = F.concat(F.lit(args[0]), out)
        elif name == "remove":
            out = F.regexp_replace(out, args[0], "")
        elif name == "replace":
            out = F.regexp_replace(out, args[0], args[1])
        elif name == "label":
            out = variable_label(out)
        else:
            raise ValueError(f"unknown clean-up step {name!r}")
    return out


# Prefixes removed from variable names for readable labels.
LABEL_PREFIXES = ("^cov_", "^density20m2_", "m2")


def variable_label(c) -> Column:
    """Readable label of a variable name: drop cover/density prefixes and the
    ``m2`` unit, underscores to spaces, sentence case."""
    out = col_of(c)
    for p in LABEL_PREFIXES:
        out = F.regexp_replace(out, p, "")
    out = F.regexp_replace(out, "_", " ")
    return sentence_case(F.lower(out))


def split_part_safe(c, sep_regex: str, index: int) -> Column:
    """``index``-th (0-based) piece of a regex split; past the end -> NULL."""
    return F.get(F.split(col_of(c), sep_regex), index)
