"""Reading a check configuration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

DEFAULT_THRESHOLD = 1.0


class ConfigError(ValueError):
    """The configuration lacks required entries; ``problems`` names each of them."""

    def __init__(self, problems: list[str]):
        super().__init__("invalid check configuration: " + "; ".join(problems))
        self.problems = problems


@dataclass(frozen=True)
class RuleSpec:
    """One configured rule. ``threshold`` is the highest passing percentage, 0 to 100."""

    table: str
    column: str
    dq_type: str
    params: Mapping[str, Any] = field(default_factory=dict)
    threshold: Any = DEFAULT_THRESHOLD


class _Reader:
    """Walks the nested configuration and notes what is missing."""

    def __init__(self):
        self.problems: list[str] = []

    def entry(self, node: Any, key: str, where: str) -> Any:
        if isinstance(node, Mapping) and key in node:
            return node[key]
        self.problems.append(f"{where} has no {key!r}")
        return None

    def entries(self, node: Any, key: str, where: str) -> list:
        found = self.entry(node, key, where)
        if found is None:
            return []
        if isinstance(found, (list, tuple)):
            return list(found)
        self.problems.append(f"{where}: {key!r} is not a list")
        return []


def read_config(config: Mapping[str, Any]) -> list[RuleSpec]:
    """Rules in the order they are configured. Raises once, with all problems found."""
    reader = _Reader()
    specs = []
    for t, table in enumerate(reader.entries(config, "tables", "config")):
        at_table = f"tables[{t}]"
        table_name = reader.entry(table, "name", at_table)
        for c, column in enumerate(reader.entries(table, "columns", at_table)):
            at_column = f"{at_table}.columns[{c}]"
            column_name = reader.entry(column, "name", at_column)
            for r, rule in enumerate(reader.entries(column, "dq_rules", at_column)):
                dq_type = reader.entry(rule, "dq_type", f"{at_column}.dq_rules[{r}]")
                if dq_type is None:
                    continue
                specs.append(
                    RuleSpec(
                        table_name,
                        column_name,
                        dq_type,
                        rule.get("params", {}),
                        rule.get("threshold", DEFAULT_THRESHOLD),
                    )
                )
    if reader.problems:
        raise ConfigError(reader.problems)
    return specs
