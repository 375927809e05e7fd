"""The registry of personal-data patterns and their expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class PiiPattern:
    """A regular expression, with facts about its matches that make it cheaper to run.

    ``literal`` and ``guard`` are a substring and a simple expression found in every text that matches; texts
    without them skip the expression. ``starts`` is the character class of a match's first character.
    """

    regex: str
    literal: str | None = None
    guard: str | None = None
    starts: str | None = None

    @property
    def java(self) -> str:
        """Unicode-aware, and tried only where a match can start."""
        return "(?U)" + (f"(?={self.starts})" if self.starts else "") + self.regex

    def possible(self, text: Column) -> Column | None:
        """A cheap test that every matching text passes."""
        test = text.contains(self.literal) if self.literal else None
        if self.guard:
            guard = text.rlike("(?U)" + self.guard)
            test = guard if test is None else test & guard
        return test


# M1. The pattern of each type, applied in this order.
PII_PATTERNS: dict[str, PiiPattern] = {
    "SSN": PiiPattern(r"\b\d{3}-\d{2}-\d{4}\b", literal="-", guard=r"\d-\d", starts=r"\d"),
    "EMAIL": PiiPattern(r"\b[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}\b", literal="@"),
    "PHONE": PiiPattern(
        r"\b(?:\+?1[-.\s]?)?(?:\(?\d{3}\)?[-.\s]?)\d{3}[-.\s]?\d{4}\b", guard=r"\d{4}", starts=r"[\d(+]"
    ),
    "CREDIT_CARD": PiiPattern(
        r"\b(?:4\d{3}|5[1-5]\d{2}|3[47]\d{2}|6(?:011|5\d{2}))[-\s]?\d{4}[-\s]?\d{4}[-\s]?\d{4}\b",
        guard=r"\d{4}", starts="[3-6]",
    ),
    "IP_ADDRESS": PiiPattern(
        r"\b(?:(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\.){3}(?:25[0-5]|2[0-4]\d|[01]?\d\d?)\b",
        guard=r"\d\.\d", starts=r"\d",
    ),
}
DEFAULT_TYPES = ("SSN", "EMAIL", "PHONE", "CREDIT_CARD")

# Parts of column names that suggest personal data.
NAME_HINTS = ("name", "email", "phone", "ssn", "address", "executive")


def placeholder(pii_type: str) -> str:
    return f"[REDACTED_{pii_type}]"


def active_patterns(types, registry: dict[str, PiiPattern] | None = None) -> dict[str, PiiPattern]:
    """The chosen types in registry order."""
    registry = PII_PATTERNS if registry is None else registry
    return {name: pattern for name, pattern in registry.items() if name in types}


def contains_pii(text: Column, pattern: PiiPattern) -> Column:
    """M2: whether ``text`` holds at least one match."""
    possible = pattern.possible(text)
    found = text.rlike(pattern.java)
    return found if possible is None else possible & found


def redact(text: Column, pii_type: str, pattern: PiiPattern) -> Column:
    """M3: every match replaced by the typed placeholder."""
    possible = pattern.possible(text)
    masked = F.regexp_replace(text, pattern.java, placeholder(pii_type))
    return masked if possible is None else F.when(possible, masked).otherwise(text)
