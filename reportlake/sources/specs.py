"""Source specs (which files feed which table) as data.

A spec says which file names a source takes (case-insensitive "contains" glob
plus optional extension), which it leaves out, how to cut attributes out of
the name, and where the files land. Specs are configuration: a few dozen rows
at most, read on the driver (TOML or dicts) and turned into literal column
expressions, so matching a catalog of any size needs no join and no shuffle.
"""

from __future__ import annotations

import re
import tomllib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

SPEC_SCHEMA = T.StructType(
    [
        T.StructField("source_id", T.StringType(), False),
        T.StructField("is_enabled", T.BooleanType(), False),
        T.StructField("select_file_name_base", T.StringType(), False),
        T.StructField("exclude_file_name_base", T.StringType(), True),
        T.StructField("regex_pattern", T.StringType(), True),
        T.StructField("regex_group_names", T.ArrayType(T.StringType()), True),
        T.StructField("storage_folder_name", T.StringType(), True),
        T.StructField("table_name", T.StringType(), True),
        T.StructField("table_append_or_replace", T.StringType(), False),
    ]
)


@dataclass(frozen=True)
class SourceSpec:
    source_id: str
    select_file_name_base: str
    is_enabled: bool = True
    exclude_file_name_base: str | None = None
    regex_pattern: str | None = None
    regex_group_names: tuple[str, ...] | None = None
    storage_folder_name: str | None = None
    table_name: str | None = None
    table_append_or_replace: str = "append"

    def __post_init__(self) -> None:
        if self.table_append_or_replace not in ("append", "replace"):
            raise ValueError(f"{self.source_id}: table_append_or_replace must be append or replace")
        if self.regex_pattern and self.regex_group_names is not None:
            groups = re.compile(self.regex_pattern).groups
            if groups != len(self.regex_group_names):
                raise ValueError(
                    f"{self.source_id}: pattern has {groups} groups, {len(self.regex_group_names)} names given"
                )

    @property
    def effective_table(self) -> str:
        return self.table_name or self.select_file_name_base

    def as_row(self) -> tuple:
        return (
            self.source_id,
            self.is_enabled,
            self.select_file_name_base,
            self.exclude_file_name_base,
            self.regex_pattern,
            list(self.regex_group_names) if self.regex_group_names is not None else None,
            self.storage_folder_name,
            self.table_name,
            self.table_append_or_replace,
        )


def glob_to_regex(glob: str) -> str:
    """fnmatch-style glob to an anchored Java regex (``*``, ``?``, ``[...]``, ``[!...]``)."""
    out, i, n = [], 0, len(glob)
    while i < n:
        ch = glob[i]
        i += 1
        if ch == "*":
            out.append(".*")
        elif ch == "?":
            out.append(".")
        elif ch == "[":
            j = i
            if j < n and glob[j] == "!":
                j += 1
            if j < n and glob[j] == "]":
                j += 1
            while j < n and glob[j] != "]":
                j += 1
            if j >= n:
                out.append("\\[")
            else:
                body = glob[i:j].replace("\\", "\\\\")
                i = j + 1
                if body.startswith("!"):
                    body = "^" + body[1:]
                elif body.startswith("^"):
                    body = "\\" + body
                out.append("[" + body + "]")
        else:
            out.append(re.escape(ch) if ch not in "/" else ch)
    return "^" + "".join(out) + "$"


def glob_condition(name_lc, glob: str):
    """Column test for an fnmatch glob over a (lower-cased) name.

    Globs built from ``*`` and literals compile to ``startswith`` /
    ``endswith`` / ``contains`` on the right slices (no regex, no
    backtracking); a glob with ``?`` or ``[...]`` falls back to an anchored regex.
    """
    from pyspark.sql import functions as F

    if "?" in glob or "[" in glob:
        return name_lc.rlike("(?s)" + glob_to_regex(glob))
    parts = glob.split("*")
    if len(parts) == 1:
        return name_lc == F.lit(glob)
    head, tail, middle = parts[0], parts[-1], [m for m in parts[1:-1] if m]
    cond = F.length(name_lc) >= len(head) + len(tail) + sum(len(m) for m in middle)
    if head:
        cond = cond & name_lc.startswith(head)
    if tail:
        cond = cond & name_lc.endswith(tail)
    if middle:
        # the literals must appear in order inside the slice between head and tail
        inner = F.substring(name_lc, len(head) + 1, F.length(name_lc) - len(head) - len(tail))
        if len(middle) == 1:
            cond = cond & inner.contains(middle[0])
        else:
            cond = cond & inner.rlike("(?s)" + ".*".join(re.escape(m) for m in middle))
    return cond


def include_glob(spec: SourceSpec, extension: str | None) -> str:
    """The include selector as a glob over the lower-cased name: ``*base*`` plus extension."""
    return f"*{spec.select_file_name_base.lower()}*{(extension or '').lower()}"


def exclude_glob(spec: SourceSpec) -> str | None:
    """The exclude selector as a glob; an empty or missing exclude excludes nothing."""
    if not spec.exclude_file_name_base:
        return None
    return f"*{spec.exclude_file_name_base.lower()}*"


def specs_from_toml(text: str) -> list[SourceSpec]:
    """Read ``[file.<id>]`` sections of a TOML config into specs."""
    doc = tomllib.loads(text)
    out = []
    for sid, sec in (doc.get("file") or {}).items():
        groups = sec.get("regex_group_names")
        out.append(
            SourceSpec(
                source_id=sid,
                select_file_name_base=sec["select_file_name_base"],
                is_enabled=bool(sec.get("is_enabled", True)),
                exclude_file_name_base=sec.get("exclude_file_name_base"),
                regex_pattern=(sec.get("regex_pattern") or "").strip() or None,
                regex_group_names=tuple(groups) if groups is not None else None,
                storage_folder_name=sec.get("storage_folder_name"),
                table_name=sec.get("table_name"),
                table_append_or_replace=sec.get("table_append_or_replace", "append"),
            )
        )
    return out


def specs_frame(spark: SparkSession, specs: list[SourceSpec]) -> DataFrame:
    """Specs as a small DataFrame (for joins against stored state and reporting)."""
    return spark.createDataFrame([s.as_row() for s in specs], SPEC_SCHEMA)
