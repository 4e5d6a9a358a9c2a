"""Business settings of one roster.

Everything that names a contract, a plan or a code system belongs to the site
that runs the roster, so those settings have no default.
"""

from __future__ import annotations

import json
from collections.abc import Mapping
from dataclasses import dataclass, field, fields
from datetime import date

# Short codes for the long gender spellings, and the code for the rest.
SEX_CODES = {"Male": "M", "Female": "F", "U": "U"}
SEX_OTHER = "OTH"

# The two accepted spellings of a primary office.
PRIMARY_OFFICE_VALUES = ("1", "Yes")


@dataclass(frozen=True)
class RosterConfig:
    contract_names: tuple[str, ...]
    plan_prefix: str
    data_sys_prefix: str
    id_prefix: str
    code_types: tuple[str, ...]
    review_prefix: str

    # Fixed value: the end date of a plan that is open.
    open_end_date: date = date(2399, 12, 31)
    primary_office_values: tuple[str, ...] = PRIMARY_OFFICE_VALUES
    practice_status: str = "Active"
    employed_label: str = "EMPLOYED"
    private_label: str = "PRIVATE"
    relationship_type: str = "Primary"
    member_status: str = "Active"
    code_status: str = "Active"
    sex_codes: Mapping[str, str] = field(default_factory=lambda: dict(SEX_CODES))
    sex_other: str = SEX_OTHER
    code_width: int = 10
    gate_threshold: int = 1
    on_overflow: str = "raise"
    only_unreviewed: bool = False
    report_missing: bool = False
    procedure_name: str = "member_roster"
    environment: str = ""
    # Newest versions of each snapshot that stay; 0: all. Replaced ones stay for some time.
    keep_versions: int = 0
    grace_hours: float = 24.0

    def __post_init__(self) -> None:
        for name in ("contract_names", "code_types", "primary_office_values"):
            value = getattr(self, name)
            if isinstance(value, str):
                raise TypeError(f"{name} must be a list of strings")
            object.__setattr__(self, name, tuple(value))
        if isinstance(self.open_end_date, str):
            object.__setattr__(self, "open_end_date", date.fromisoformat(self.open_end_date))
        if self.on_overflow not in ("raise", "quarantine"):
            raise ValueError("on_overflow must be 'raise' or 'quarantine'")
        if self.keep_versions < 0 or self.grace_hours < 0:
            raise ValueError("keep_versions and grace_hours cannot be negative")

    @classmethod
    def from_json(cls, path: str) -> RosterConfig:
        with open(path, encoding="utf-8") as handle:
            return cls.from_dict(json.load(handle))

    @classmethod
    def from_dict(cls, values: Mapping) -> RosterConfig:
        unknown = set(values) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown roster settings: {sorted(unknown)}")
        return cls(**values)
