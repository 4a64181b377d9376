"""Path and object-name checks as Column expressions (lexical, no filesystem calls)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's for equal results.
MAX_OBJECT_NAME = 1024


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def lexical_normalize(path: Column | str) -> Column:
    """Fold ``.`` and ``..`` segments of a ``/`` path without touching the filesystem.

    Returns the normalised path; a ``..`` that would climb above the start is
    kept as ``..`` so the result can be compared with a root prefix.
    """
    p = _c(path)
    parts = F.split(p, "/")

    def step(acc: Column, seg: Column) -> Column:
        last = F.element_at(acc, -1)
        can_pop = (F.size(acc) > 0) & (last != "..") & (last != "")
        return (
            F.when((seg == ".") | ((seg == "") & (F.size(acc) > 0)), acc)
            .when((seg == "..") & can_pop, F.slice(acc, 1, F.greatest(F.size(acc) - 1, F.lit(0))))
            .when((seg == "..") & (F.size(acc) == 1) & (F.element_at(acc, 1) == ""), acc)
            .otherwise(F.concat(acc, F.array(seg)))
        )

    folded = F.aggregate(parts, F.array().cast("array<string>"), step)
    joined = F.array_join(folded, "/")
    return F.when(joined == "", F.when(p.startswith("/"), F.lit("/")).otherwise(F.lit("."))).otherwise(joined)


def is_within(path: Column | str, root: str) -> Column:
    """True when the lexically normalised path lies inside ``root`` (or is it)."""
    r = root.rstrip("/") or "/"
    n = lexical_normalize(path)
    prefix = r if r.endswith("/") else r + "/"
    return (n == F.lit(r)) | n.startswith(prefix)


def percent_decoded(name: Column) -> Column:
    """One round of percent-decoding: every good escape becomes its byte, anything else (bad escapes,
    ``+``) stays; bytes that are no UTF-8 become the replacement character."""
    head = F.split(name, "%")

    def piece(part: Column) -> Column:
        escape = F.substring(part, 1, 2)
        rest = F.hex(F.encode(F.substring(part, F.lit(3), F.length(part)), "UTF-8"))
        return F.when(escape.rlike("^[0-9a-fA-F]{2}$"), F.concat(escape, rest)).otherwise(
            F.concat(F.lit("25"), F.hex(F.encode(part, "UTF-8")))
        )

    tail = F.transform(F.slice(head, 2, F.size(head)), piece)
    raw = F.concat(F.hex(F.encode(F.element_at(head, 1), "UTF-8")), F.array_join(tail, ""))
    return F.when(name.rlike("%[0-9a-fA-F]{2}"), F.make_valid_utf8(F.unhex(raw).cast("string"))).otherwise(name)


def object_name_violations(name: Column | str, max_length: int = MAX_OBJECT_NAME) -> Column:
    """Array of rule names an object name breaks (empty array = valid).

    Rules: too long, ``..`` anywhere, leading ``/``, control characters; each also checked on every
    percent-decoded form, decoded until nothing changes (a form gets shorter each time, so the
    number of escape characters bounds the rounds).
    """
    n = _c(name)
    rounds = F.sequence(F.lit(1), F.greatest((F.length(n) / 2).cast("int"), F.lit(1)))

    def again(forms: Column, _: Column) -> Column:
        last = F.element_at(forms, -1)
        return F.when(last.rlike("%[0-9a-fA-F]{2}"), F.concat(forms, F.array(percent_decoded(last)))).otherwise(forms)

    forms = F.when(n.contains("%"), F.aggregate(rounds, F.array(n), again)).otherwise(F.array(n))
    return F.filter(
        F.array(
            F.when(F.exists(forms, lambda f: F.length(f) > max_length), F.lit("too_long")),
            F.when(F.exists(forms, lambda f: f.contains("..") | f.startswith("/")), F.lit("path_traversal")),
            F.when(F.exists(forms, lambda f: f.rlike("[\\x00-\\x1f]")), F.lit("control_chars")),
        ),
        lambda x: x.isNotNull(),
    )
