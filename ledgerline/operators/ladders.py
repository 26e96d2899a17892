"""Rule ladders: ordered rule tables compiled into one ``CASE WHEN`` expression.

A ladder is data: a tuple of ``Rule`` rows, tested top to bottom, first match wins,
and a rule either multiplies the base amount by a factor or yields a constant. The
compiled expression is a single Catalyst ``CaseWhen`` (whole-stage code generation,
no Python at run time). Factors are exact decimals, so decimal amounts stay exact.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import norm


@dataclass(frozen=True)
class Rule:
    """``tests``: ``(column, op, value)`` triples, all must hold. ``op`` is one of
    ``in`` (numeric set), ``kin`` (string set under the collation),
    ``>=``, ``>``, ``=``, ``<``, ``like``, ``nlike``.
    ``factor``: multiply the base by it ("1" returns the base unchanged);
    ``constant``: return this value instead (the base is not read)."""

    tests: tuple
    factor: str | None = None
    constant: str | None = None
    label: str = ""


def _q(col: str) -> str:
    """Column reference for a SQL expression (backticks allow blanks in names)."""
    return "`" + col.replace("`", "``") + "`"


def _s(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _key(col: str) -> str:
    return f"upper(rtrim({_q(col)}))"


def _test(col: str, op: str, value) -> str:
    c = _q(col)
    if op == "in":
        return f"{c} IN ({', '.join(str(int(v)) for v in value)})"
    if op == "kin":
        return f"{_key(col)} IN ({', '.join(_s(norm(v)) for v in value)})"
    if op in (">=", ">", "=", "<"):
        return f"{c} {op} {value}"
    if op == "like":
        return f"{c} ILIKE {_s(value)}"
    if op == "nlike":
        return f"NOT ({c} ILIKE {_s(value)})"
    raise ValueError(f"unknown test {op!r}")


def _result(rule: Rule, base: str) -> str:
    if rule.constant is not None:
        return rule.constant
    if rule.factor == "1":
        return base
    # exact numeric literal: parsed as DECIMAL by Spark SQL
    return f"{base} * {Decimal(rule.factor)}"


def ladder_sql(rules, base: str, otherwise: str | None = None) -> str:
    arms = " ".join(
        f"WHEN {' AND '.join(_test(*t) for t in r.tests)} THEN {_result(r, _q(base))}" for r in rules)
    return f"CASE {arms} ELSE {_q(base) if otherwise is None else otherwise} END"


def compile_ladder(rules, base: str, otherwise: str | None = None) -> Column:
    """Fold the rules into one ``CASE WHEN`` over column ``base``; no match ->
    ``otherwise`` (a SQL expression; default: the base amount unchanged).

    The rule table is rendered as one SQL expression and handed to Spark's parser in a
    single call, so building the plan costs one round trip, not one per literal."""
    return F.expr(ladder_sql(rules, base, otherwise))


def classify(classes, otherwise: str, col: str = "Insurer Name") -> Column:
    return F.expr(classify_sql(classes, otherwise, col))


def classify_sql(classes, otherwise: str, col: str = "Insurer Name") -> str:
    """Label from ordered ``(label, equals, patterns)`` classes: a row gets the first
    label whose exact values (collation) or LIKE patterns match."""
    arms = []
    for label, equals, patterns in classes:
        tests = []
        if equals:
            tests.append(_test(col, "kin", equals))
        tests.extend(_test(col, "like", p) for p in patterns)
        arms.append(f"WHEN {' OR '.join(tests)} THEN {_s(label)}")
    return f"CASE {' '.join(arms)} ELSE {_s(otherwise)} END"


# ---------------------------------------------------------------------------
# The reference's rule tables, in the reference's order.
# ---------------------------------------------------------------------------

NEW_OR_RENEWAL = ("New", "Renewal")


def motor_rules(tw_tp_offline_factor: str = "0") -> tuple:
    """Motor ladder on netpr -> Accrual_Net_Pr.
    Columns: Product_updated, ODTerm, TPTerm, BookingMode, Motor_bt."""
    P, OD, TP, M, BT = "Product_updated", "ODTerm", "TPTerm", "BookingMode", "Motor_bt"
    on, off = (M, "kin", ("Online",)), (M, "kin", ("Offline",))
    new, ren, both = (BT, "kin", ("New",)), (BT, "kin", ("Renewal",)), (BT, "kin", NEW_OR_RENEWAL)
    return (
        # commercial vehicle
        Rule(((P, "in", (188,)), on, both), "1", label="cv online"),
        Rule(((P, "in", (188,)), off, both), ".9", label="cv offline"),
        # private car, brand new
        Rule(((P, "in", (186,)), (OD, ">=", 1), (TP, ">=", 3), on, both), "1", label="car new online"),
        Rule(((P, "in", (186,)), (OD, ">=", 1), (TP, ">=", 3), off, new), ".9", label="car new offline new"),
        Rule(((P, "in", (186,)), (OD, ">=", 1), (TP, ">=", 3), off, ren), ".8", label="car new offline renewal"),
        # private car, comprehensive / own damage
        Rule(((P, "in", (186,)), (OD, ">", 0), on, new), "1.2", label="car comp online new"),
        Rule(((P, "in", (186,)), (OD, ">", 0), on, ren), "1", label="car comp online renewal"),
        Rule(((P, "in", (186,)), (OD, ">", 0), off, new), ".9", label="car comp offline new"),
        Rule(((P, "in", (186,)), (OD, ">", 0), off, ren), ".8", label="car comp offline renewal"),
        # private car, third party only
        Rule(((P, "in", (186,)), (OD, "=", 0), (TP, ">", 0), on, both), "1", label="car tp online"),
        Rule(((P, "in", (186,)), (OD, "=", 0), (TP, ">", 0), off, both), ".5", label="car tp offline"),
        # two wheeler, brand new
        Rule(((P, "in", (187,)), (OD, ">=", 1), (TP, ">=", 5), on, both), "1", label="tw new online"),
        Rule(((P, "in", (187,)), (OD, ">=", 1), (TP, ">=", 5), off, both), ".8", label="tw new offline"),
        # two wheeler, comprehensive / own damage
        Rule(((P, "in", (187,)), (OD, ">", 0), on, new), "1.1", label="tw comp online new"),
        Rule(((P, "in", (187,)), (OD, ">", 0), on, ren), "1", label="tw comp online renewal"),
        Rule(((P, "in", (187,)), (OD, ">", 0), off, both), "0", label="tw comp offline"),
        # two wheeler, third party only
        Rule(((P, "in", (187,)), (OD, "=", 0), (TP, ">", 0), on, both), "1", label="tw tp online"),
        Rule(((P, "in", (187,)), (OD, "=", 0), (TP, ">", 0), off, both), tw_tp_offline_factor, label="tw tp offline"),
    )


def health_fresh_rules() -> tuple:
    """Health-fresh ladder on netpr (APE). Columns: Product_updated, Health_bt, SumInsured."""
    P, BT, SI = "Product_updated", "Health_bt", "SumInsured"
    return (
        Rule(((P, "in", (3, 118, 130, 189, 147, 224)),), "1.25"),
        Rule(((P, "in", (190,)), (BT, "kin", ("New",)), (SI, ">=", 1000000)), "1.25"),
        Rule(((P, "in", (190,)), (BT, "kin", ("New",)), (SI, ">=", 500000), (SI, "<", 1000000)), ".75"),
        Rule(((P, "in", (190,)), (SI, "<", 500000)), "0"),
        Rule(((P, "in", (190,)), (BT, "kin", ("Port",)), (SI, ">=", 1000000)), ".5"),
        Rule(((P, "in", (190,)), (BT, "kin", ("Port",)), (SI, "<", 1000000)), constant="0"),
        Rule(((P, "in", (106, 138, 144)),), "1"),
    )


def life_rules() -> tuple:
    """Life ladder on netpr (BasicPremium). Columns: PaymentPeriodicity, PayoutProdCat, PayTerm."""
    return (
        Rule((("PaymentPeriodicity", "kin", ("Single", "Single pay", "Single Premium")),), constant="0"),
        Rule((("PayoutProdCat", "kin", ("ULIP",)),), constant="0"),
        Rule((("PayTerm", "in", (2, 3, 4)),), ".5"),
    )


def sme_rules() -> tuple:
    """SME ladder on netpr (Net Premium). Column: PlanName."""
    gg = "Group Gratuity Plan"
    return (
        Rule((("PlanName", "kin", (gg,)),), ".1"),
        Rule((("PlanName", "like", "%Group%"),), ".25"),
        Rule((("PlanName", "nlike", "%Group%"),), "1.25"),
    )


# Insurer classes: (label, exact names, LIKE patterns), first match wins.
GENERAL_PSU_PATTERNS = ("%National Insurance%", "%Oriental%", "%United%", "%New India%")
MOTOR_INSURER_CLASSES = (
    ("PSU", (), GENERAL_PSU_PATTERNS),
    ("Pvt", (), ("%Sompo%", "%Iffco%", "%Shriram%", "%Raheja%")),
)
HEALTH_INSURER_CLASSES = (("PSU", (), GENERAL_PSU_PATTERNS),)
LIFE_INSURER_CLASSES = (
    ("PSU", ("LIC India",), ("SBI%",)),
    ("Pvt", (), ("HDFC%", "ICICI%", "Tata%", "bajaj%", "axis%", "Birla%")),
)
OTHERS = "Others_pvt"
