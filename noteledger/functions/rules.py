"""Row validation rules over a record table whose column names are parameters.

SQL three-valued logic is kept on purpose: a NULL code is neither counted
invalid nor valid, exactly as ``NOT (x REGEXP p)`` behaves in SQL.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import CODE_REPORT, MSG_BAD_AGE, MSG_SHORT_TEXT
from .text import strip_ws


@dataclass(frozen=True)
class RecordColumns:
    """Names of the columns the validation reports look at."""

    id: str = "patient_id"
    age: str = "age"
    gender: str = "gender"
    text: str = "diagnosis_text"
    code: str = "icd10_code"
    stay: str = "length_of_stay"
    severity: str = "severity_score"
    # optional precomputed length(trim(text)); lets a role shuffle an int
    # instead of the text when only the length rules are evaluated
    text_length: str | None = None
    code_pattern: str = CODE_REPORT
    min_text_length: int = 10
    min_age: int = 0
    max_age: int = 120


@dataclass(frozen=True)
class Rule:
    name: str
    invalid: Column  # the violation predicate (three-valued)
    issue: str  # label used by the first-failing-rule column


class Rules:
    """Predicates of the validation report for one column mapping."""

    def __init__(self, cols: RecordColumns = RecordColumns()):
        self.cols = cols
        c = cols
        self.id = F.col(c.id)
        self.age_int = F.col(c.age).try_cast("int")
        self.stay_int = F.col(c.stay).try_cast("int")
        self.text_len = F.col(c.text_length) if c.text_length else F.length(F.trim(F.col(c.text)))
        self.text_present = F.col(c.text_length or c.text).isNotNull()
        self.code = F.col(c.code)

    # validity predicates
    def id_present(self) -> Column:
        return self.id.isNotNull()

    def age_valid(self) -> Column:
        return (self.age_int >= self.cols.min_age) & (self.age_int <= self.cols.max_age)

    def stay_valid(self) -> Column:
        return self.stay_int >= 0

    def text_valid(self) -> Column:
        return self.text_len >= self.cols.min_text_length

    def code_valid(self) -> Column:
        return self.code.rlike(self.cols.code_pattern)

    def fully_valid(self) -> Column:
        c = self.cols
        parts = [
            F.col(c.id).isNotNull(),
            self.text_present,
            F.col(c.code).isNotNull(),
            self.age_valid(),
            self.stay_valid(),
            self.text_valid(),
            self.code_valid(),
        ]
        return reduce(lambda a, b: a & b, parts)

    # violation predicates, in report order
    def violations(self) -> list[Rule]:
        c = self.cols
        return [
            Rule("invalid_age", (self.age_int < c.min_age) | (self.age_int > c.max_age), "Invalid age"),
            Rule("negative_length_of_stay", self.stay_int < 0, "Negative length of stay"),
            Rule("short_diagnosis_text", self.text_len < c.min_text_length, "Short diagnosis text"),
            Rule("invalid_icd10_format", ~self.code.rlike(c.code_pattern), "Invalid ICD-10 format"),
        ]

    def issue_rules(self) -> list[Rule]:
        """Rules of the invalid-record extract, in CASE order."""
        c = self.cols
        v = self.violations()
        return [
            Rule("missing_id", self.id.isNull(), "Missing patient_id"),
            Rule("missing_age", F.col(c.age).isNull(), "Missing age"),
        ] + v

    def first_issue(self) -> Column:
        """Name of the first failing rule, else 'Valid' (NULL predicates fall through)."""
        rules = self.issue_rules()
        expr = F.when(rules[0].invalid, rules[0].issue)
        for r in rules[1:]:
            expr = expr.when(r.invalid, r.issue)
        return expr.otherwise("Valid")

    def any_issue(self) -> Column:
        rules = self.issue_rules()
        return reduce(lambda a, b: a | b, [r.invalid for r in rules])


def input_errors(text, age=None, min_length: int = 10, min_age: int = 0, max_age: int = 120,
                 stripped_length=None) -> Column:
    """List of validation messages for one scoring input (empty when fine).

    ``stripped_length`` may give a precomputed length(strip(text)) (NULL for
    a NULL text) in place of ``text``."""
    if stripped_length is not None:
        n = F.col(stripped_length) if isinstance(stripped_length, str) else stripped_length
        short = n.isNull() | (n < min_length)
    else:
        t = F.col(text) if isinstance(text, str) else text
        short = t.isNull() | (F.length(strip_ws(t)) < min_length)
    msgs = [F.when(short, F.lit(MSG_SHORT_TEXT))]
    if age is not None:
        a = F.col(age) if isinstance(age, str) else age
        msgs.append(F.when(a.isNotNull() & ((a < min_age) | (a > max_age)), F.lit(MSG_BAD_AGE)))
    return F.filter(F.array(*msgs), lambda m: m.isNotNull())
