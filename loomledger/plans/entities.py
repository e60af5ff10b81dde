"""Declarative description of the nine landed entities."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

from loomledger.functions import columns as c

Cleanser = Callable[[Column], Column]


def _text(raw: Column) -> Column:
    return raw


def _money(raw: Column) -> Column:
    return c.to_money(c.to_number(raw))


def _money_not_negative(raw: Column) -> Column:
    return c.not_negative(_money(raw))


def _whole_or(default: int) -> Cleanser:
    return lambda raw: c.or_default(c.to_whole(c.to_number(raw)), default)


def _credit_score(raw: Column) -> Column:
    return c.credit_score(c.to_number(raw))


@dataclass(frozen=True)
class Entity:
    """One landed entity: where it comes from, its key and its typed columns.

    ``columns`` maps each payload key, in output order, to its cleanser.
    ``amounts`` are the payload keys whose JSON type drifts between batches;
    ``fractional`` are those of them that carry cents when clean, so that a
    batch of whole numbers only can be recognised as minor units.
    """

    source: str
    name: str
    key: str
    columns: dict[str, Cleanser]
    amounts: tuple[str, ...] = ()
    fractional: tuple[str, ...] = ()
    key_required: bool = True
    statuses: dict[str, list[str]] = field(default_factory=dict)

    @property
    def table(self) -> str:
        return f"stg_{self.source}__{self.name}"

    def only(self, *names: str) -> Entity:
        """The same entity narrowed to its key and the named columns."""
        kept = {name: cleanse for name, cleanse in self.columns.items() if name == self.key or name in names}
        return replace(self, columns=kept)

    @property
    def dates(self) -> list[str]:
        return [name for name, cleanser in self.columns.items() if cleanser is c.parse_date]


_ENTITIES = [
    Entity(
        "payments", "subscriptions", "subscription_id",
        {
            "subscription_id": _text,
            "customer_id": _text,
            "plan_id": lambda raw: c.or_default(raw, "unknown"),
            "plan_name": _text,
            "mrr_amount": _money,
            "currency": c.currency,
            "status": F.lower,
            "billing_period_start": c.parse_date,
            "billing_period_end": c.parse_date,
            "quantity": _whole_or(1),
            "created_at": c.parse_date,
        },
        amounts=("mrr_amount",), fractional=("mrr_amount",),
    ),
    Entity(
        "payments", "invoices", "invoice_id",
        {
            "invoice_id": _text,
            "customer_id": _text,
            "subscription_id": _text,
            "amount": _money,
            "currency": c.currency,
            "invoice_date": c.parse_date,
            "due_date": c.parse_date,
            "paid_at": c.parse_date,
            "status": F.lower,
            "line_items_json": _text,
        },
        amounts=("amount",), fractional=("amount",),
    ),
    Entity(
        "lending", "loan_applications", "application_id",
        {
            "application_id": _text,
            "customer_id": _text,
            "company_name": _text,
            "company_registration_number": c.blank_to_null,
            "country_code": c.country,
            "industry": _text,
            "requested_amount": _money,
            "currency": c.currency,
            "application_date": c.parse_date,
            "status": F.lower,
            "credit_score": _credit_score,
            "risk_rating": _text,
            "headcount_at_application": _whole_or(0),
            "valuation_at_application": _money,
            "arr_at_application": _money,
            "referral_source": _text,
        },
        amounts=("requested_amount",), fractional=("requested_amount",),
    ),
    Entity(
        "lending", "credit_facilities", "facility_id",
        {
            "facility_id": _text,
            "customer_id": _text,
            "application_id": _text,
            "facility_limit": _money_not_negative,
            "currency": c.currency,
            "approval_date": c.parse_date,
            "maturity_date": c.parse_date,
            "status": F.lower,
            "interest_rate": c.to_number,
            "repayment_schedule_json": _text,
            "collateral_required": _text,
        },
        amounts=("facility_limit",), fractional=("facility_limit",),
    ),
    Entity(
        "lending", "drawdowns", "drawdown_id",
        {
            "drawdown_id": _text,
            "facility_id": _text,
            "customer_id": _text,
            "amount": _money_not_negative,
            "currency": c.currency,
            "drawdown_date": c.parse_date,
            "purpose": _text,
            "status": F.lower,
        },
        amounts=("amount",), fractional=("amount",),
        # Rows without an id are not dropped; together they count as one key.
        key_required=False,
    ),
    Entity(
        "lending", "repayments", "repayment_id",
        {
            "repayment_id": _text,
            "drawdown_id": _text,
            "facility_id": _text,
            "customer_id": _text,
            "scheduled_amount": _money,
            "actual_amount": _money,
            "currency": c.currency,
            "due_date": c.parse_date,
            "actual_date": c.parse_date,
            "status": F.lower,
        },
        amounts=("scheduled_amount", "actual_amount"), fractional=("scheduled_amount", "actual_amount"),
    ),
    Entity(
        "banking", "fx_transactions", "transaction_id",
        {
            "transaction_id": _text,
            "customer_id": _text,
            "base_currency": c.currency,
            "quote_currency": c.currency,
            "base_amount": _money,
            "quote_amount": _money,
            "rate": c.to_number,
            "rate_type": _text,
            "transaction_date": c.parse_date,
            "counterparty_bank_bic": _text,
        },
        amounts=("base_amount", "quote_amount"), fractional=("quote_amount",),
    ),
    Entity(
        "banking", "account_balances", "snapshot_id",
        {
            "snapshot_id": _text,
            "customer_id": _text,
            "account_id": _text,
            "currency": c.currency,
            "balance": _money_not_negative,
            "snapshot_date": c.parse_date,
            "account_type": F.lower,
        },
        amounts=("balance",),
    ),
    Entity(
        "crm", "company_metrics", "metric_id",
        {
            "metric_id": _text,
            "customer_id": _text,
            "metric_date": c.parse_date,
            "headcount": _whole_or(0),
            "valuation": _money,
            "arr_reported": _money,
        },
        amounts=("valuation", "arr_reported"),
    ),
]

ENTITIES: dict[str, Entity] = {entity.name: entity for entity in _ENTITIES}
