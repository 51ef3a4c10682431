"""Where resources' rows come from: tables by name and repo, tenants, and the values of templates."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.errors import PlanError
from tessera.schema import Domain, Resource

_TENANT = re.compile(r"^[A-Za-z0-9_-]+$")
_aliases = itertools.count()


def parquet_tables(spark: SparkSession, folder: str) -> Callable[[str, str | None], DataFrame]:
    """Loads <folder>[/<tenant>]/<table>.parquet."""

    def load(table: str, tenant: str | None) -> DataFrame:
        return spark.read.parquet(f"{folder}/{tenant}/{table}.parquet" if tenant else f"{folder}/{table}.parquet")

    return load


@dataclass(frozen=True)
class Engine:
    """A domain with its sources. repos: a loader (table, tenant) -> DataFrame for each repo, "default" at least."""

    spark: SparkSession
    domain: Domain
    repos: Mapping[str, Callable[[str, str | None], DataFrame]]
    tenant: str | None = None
    actor: Mapping[str, Any] = field(default_factory=dict)
    context: Mapping[str, Any] = field(default_factory=dict)
    arguments: Mapping[str, Any] = field(default_factory=dict)
    tables: Mapping[str, str] = field(default_factory=dict)

    def with_values(self, **changes) -> Engine:
        return replace(self, **changes)

    def template(self, kind: str, key: str | None) -> Any:
        if kind == "tenant":
            return self.tenant
        values = {"actor": self.actor, "context": self.context, "arg": self.arguments}[kind]
        if key not in values:
            raise PlanError(f"no {kind} value {key}")
        return values[key]

    def rows(self, resource: Resource, alias: str, mutating: bool = False) -> DataFrame:
        """All rows, each attribute as <alias>_<attribute>; for a mutation from the repo that takes it."""
        name = self.tables.get(resource.name, resource.table)
        if not name:
            raise PlanError(f"{resource.name}: a polymorphic resource needs a table")
        if resource.tenant_by and self.tenant is not None and not _TENANT.match(self.tenant):
            raise PlanError(f"{self.tenant!r} is no tenant name")
        prefix = self.tenant if resource.tenant_by == "schema" else None
        if resource.tenant_by and self.tenant is None:
            raise PlanError(f"{resource.name}: a tenant is needed")
        repo = resource.mutate_repo or resource.repo if mutating else resource.repo
        if repo not in self.repos:
            raise PlanError(f"no repo {repo}")
        df = self.repos[repo](name, prefix)
        if resource.tenant_by == "attribute":
            df = df.filter(F.col(resource.tenant_attribute) == F.lit(self.tenant))
        stored = lambda a: F.col(a.source or a.name)
        # case-insensitive strings carry their collation, so that all comparisons follow it
        own = lambda a: F.collate(stored(a), "UTF8_LCASE") if a.type == "ci_string" else stored(a)
        return df.select(*[own(a).alias(f"{alias}_{a.name}") for a in resource.attributes])

    def alias(self) -> str:
        return f"t{next(_aliases)}"

    def evaluate(self, expression) -> Any:
        """The value of an expression that needs no row."""
        from tessera.plans.scope import Scope

        scope = Scope.bare(self)
        column = scope.column(expression).alias("value")
        return scope.df.select(column).first()["value"]
