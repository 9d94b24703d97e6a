"""Frozen settings. Every value becomes a literal in the plan."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from typing import Any

HOUR_MS = 3_600_000
DAY_MS = 86_400_000

# Fixed values of the request model.
WORKFLOW_REQUEST = "WORKFLOW_FORM_REQUEST"
PENDING = "PENDING"
COMPLETED = "COMPLETED"
ACCEPTED = "ACCEPTED"
REJECTED = "REJECTED"
WARNING = "warning"
ESCALATION = "escalation"

# Fixed values of the change-event envelope.
CHANGE_EVENT_TYPE = "MetadataChangeLogEvent_v1"
CHANGE_ENTITY_TYPE = "actionRequest"
CHANGE_ASPECT = "actionRequestStatus"

# Fixed values of the target warehouse: object not found or not authorised.
PERMANENT_ERRNOS = (2001, 2003)

GUARDS = ("ledger", "latest")
USERNAME_FORMATS = ("urn_id", "email_local_part")


@dataclass(frozen=True)
class FieldIds:
    """Ids of the six form fields that have a meaning here."""

    database: str = "snowflake_database"
    schema: str = "snowflake_schema"
    role: str = "snowflake_role"
    duration: str = "access_duration_days"
    email: str = "requestor_email"
    justification: str = "justification"


@dataclass(frozen=True)
class StateNames:
    """Where the state tables live in a catalog."""

    database: str = "GOVERNANCE"
    schema: str = "ACCESS"
    grants_table: str = "ACCESS_GRANTS"
    sla_table: str = "ACCESS_SLA_NOTIFICATIONS"
    errors_table: str = "ACCESS_ERRORS"

    def qualified(self, table: str) -> str:
        return f"{self.database}.{self.schema}.{table}"

    @property
    def qualified_grants_table(self) -> str:
        return self.qualified(self.grants_table)

    @property
    def qualified_sla_table(self) -> str:
        return self.qualified(self.sla_table)

    @property
    def qualified_errors_table(self) -> str:
        return self.qualified(self.errors_table)


@dataclass(frozen=True)
class Settings:
    """One pass is a function of its inputs, these settings and the clock ``as_of_ms``.

    ``guard`` says which requests count as already provisioned:

    * ``ledger``: every request URN that was ever granted for real;
    * ``latest``: only the URN now stored in an active grant row, applied in
      listing order, so that two requests for one access key displace each
      other on every pass.

    ``count_dry_runs`` makes the state rows of dry runs count like real ones.

    ``keep_shared_privileges`` leaves a privilege in force that another active grant of the role
    still needs; otherwise a revoke takes its own statements, whoever shares them.
    """

    as_of_ms: int
    lookback_days: int = 90
    warning_after_hours: int = 24
    escalation_after_hours: int = 72
    escalation_recipients: tuple[str, ...] = ()
    expiry_enabled: bool = True
    revocation_notification: bool = True
    default_warehouse: str | None = None
    dry_run: bool = False
    count_dry_runs: bool = False
    username_format: str = "urn_id"
    guard: str = "ledger"
    dedup_denials: bool = True
    check_failures_live: bool = False
    check_identifiers: bool = False
    keep_shared_privileges: bool = False
    catalog_name: str = "data catalog"
    target_name: str = "warehouse"
    hot_key_rows: int = 1_000_000
    fields: FieldIds = field(default_factory=FieldIds)
    state: StateNames = field(default_factory=StateNames)

    def __post_init__(self) -> None:
        if self.hot_key_rows < 1:
            raise ValueError(f"hot_key_rows must be positive, not {self.hot_key_rows!r}")
        if self.guard not in GUARDS:
            raise ValueError(f"guard must be one of {GUARDS}, not {self.guard!r}")
        if self.username_format not in USERNAME_FORMATS:
            raise ValueError(
                f"username_format must be one of {USERNAME_FORMATS}, not {self.username_format!r}"
            )

    @property
    def since_ms(self) -> int:
        return self.as_of_ms - self.lookback_days * DAY_MS

    @classmethod
    def from_mapping(cls, config: Mapping[str, Any], as_of_ms: int, **overrides: Any) -> Settings:
        """Build settings from a nested configuration mapping (as loaded from YAML).

        Sections that only concern connections or mail delivery are ignored.
        """
        sla = config.get("sla") or {}
        expiry = config.get("expiry") or {}
        provisioning = config.get("provisioning") or {}
        state = config.get("state") or {}
        values: dict[str, Any] = {
            "lookback_days": config.get("lookback_days"),
            "warning_after_hours": sla.get("warning_after_hours"),
            "escalation_after_hours": sla.get("escalation_after_hours"),
            "escalation_recipients": sla.get("escalation_recipients"),
            "expiry_enabled": expiry.get("enabled"),
            "revocation_notification": expiry.get("revocation_notification"),
            "default_warehouse": provisioning.get("default_warehouse"),
            "dry_run": provisioning.get("dry_run"),
            "username_format": provisioning.get("requestor_username_format"),
        }
        values = {name: value for name, value in values.items() if value is not None}
        if "escalation_recipients" in values:
            values["escalation_recipients"] = tuple(values["escalation_recipients"])
        form_keys = {
            "database": "field_snowflake_database",
            "schema": "field_snowflake_schema",
            "role": "field_snowflake_role",
            "duration": "field_access_duration_days",
            "email": "field_requestor_email",
            "justification": "field_justification",
        }
        values["fields"] = FieldIds(
            **{name: config[key] for name, key in form_keys.items() if config.get(key)}
        )
        names = {f.name for f in fields(StateNames)}
        values["state"] = StateNames(**{k: v for k, v in state.items() if k in names})
        values.update(overrides)
        return cls(as_of_ms=as_of_ms, **values)
