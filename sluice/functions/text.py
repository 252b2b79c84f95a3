"""Text rules: Unicode strip, blank checks, identifier patterns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's ``str.strip()`` removes (below U+3100),
# written as a Java regex class and as the same class in RE2 spelling.
STRIP_CLASS_JAVA = (
    "[\\u0009-\\u000D\\u001C-\\u0020\\u0085\\u00A0\\u1680\\u2000-\\u200A"
    "\\u2028\\u2029\\u202F\\u205F\\u3000]"
)
STRIP_CLASS_RE2 = (
    "[\\x{09}-\\x{0D}\\x{1C}-\\x{20}\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}"
    "\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]"
)

_STRIP_PATTERN = f"\\A{STRIP_CLASS_JAVA}+|{STRIP_CLASS_JAVA}+\\z"

# Lowercase SHA-256 hex, and the orchestration failure-code shape.
SHA256_PATTERN = "\\A[0-9a-f]{64}\\z"
FAILURE_CODE_PATTERN = "\\A[A-Z0-9][A-Z0-9_.-]{0,63}\\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_strip(c: Column | str) -> Column:
    """Remove leading/trailing Unicode whitespace, as Python ``str.strip()``.

    Most texts begin and end with a visible ASCII character and need no pattern."""
    s = _col(c)
    visible = lambda at: F.ascii(F.substring(s, at, 1)).between(33, 126)
    return F.when(visible(1) & visible(-1), s).otherwise(F.regexp_replace(s, _STRIP_PATTERN, ""))


def normalize_identifier(c: Column | str) -> Column:
    """stripped identifier; null when the stripped value is blank.

    Use :func:`non_blank` on the same input to tell a blank value (which the
    reference treats as a configuration fault) from a present one."""
    s = unicode_strip(c)
    return F.when(s != "", s)


def normalize_text(c: Column | str) -> Column:
    """the same rule for names."""
    return normalize_identifier(c)


def non_blank(c: Column | str) -> Column:
    """true when the value has a non-whitespace character (Python rule)."""
    return unicode_strip(c) != ""


def btrim_blank(c: Column | str) -> Column:
    """F13 (SQL flavour): ``btrim(x) = ''``, spaces only, as the SQL CHECKs use."""
    return F.trim(_col(c)) == ""


def is_sha256(c: Column | str) -> Column:
    """64 lowercase hex characters."""
    return _col(c).rlike(SHA256_PATTERN)


def is_failure_code(c: Column | str) -> Column:
    """bounded failure code."""
    return _col(c).rlike(FAILURE_CODE_PATTERN)


def is_relative_path(c: Column | str) -> Column:
    """normalised POSIX relative path (no '', '.', absolute, drive,
    backslash, '.'/'..' part, empty part or trailing slash)."""
    p = _col(c)
    return (
        p.isNotNull()
        & (p != "")
        & (p != ".")
        & ~p.startswith("/")
        & ~p.rlike("\\A[A-Za-z]:")
        & ~p.contains("\\")
        & ~p.rlike("(\\A|/)\\.{1,2}(/|\\z)")
        & ~p.rlike("//")
        & ~p.endswith("/")
    )


def scope_reference(kind: str, *parts: Column | str) -> Column:
    """``kind:part1:part2`` scope references."""
    cols = [F.lit(kind)] + [_col(p) for p in parts]
    return F.concat_ws(":", *cols)
