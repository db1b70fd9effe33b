"""Made-up change events for load tests, as a function of seed and row number alone.

Each number is drawn from the digest of (seed, row, field): there is no state, so any partitioning, order or subset of rows gives the
same rows, tasks that run again give them again, and a billion rows need no driver. All of it are JVM expressions. Dates lie before a
fixed ``now``, which ``shift_days`` moves; ``tenant`` puts all rows under one company and location.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..model import EVENT, UPDATE

YEAR = 365 * 86_400


@dataclass(frozen=True)
class Draws:
    """Independent draws of a row, one a field."""

    seed: int
    row: Column

    def _digest(self, field: str) -> Column:
        return F.md5(F.concat(F.lit(f"{self.seed}:"), self.row.cast("string"), F.lit(f":{field}")).cast("binary"))

    def number(self, field: str, below: int) -> Column:
        """A whole number from 0 to ``below`` - 1."""
        return F.conv(F.substring(self._digest(field), 1, 8), 16, 10).cast("long") % below

    def chance(self, field: str, percent: int) -> Column:
        return self.number(f"{field}?", 100) < percent

    def one_of(self, field: str, values: list[str]) -> Column:
        return F.element_at(F.array(*map(F.lit, values)), (self.number(field, len(values)) + 1).cast("int"))

    def named(self, field: str, stem: str, below: int = 1000) -> Column:
        return F.concat(F.lit(stem), self.number(field, below).cast("string"))

    def uuid(self, field: str) -> Column:
        return F.regexp_replace(self._digest(field), "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")


def customer(draws: Draws, now: int, company: Column, location: Column) -> Column:
    """A customer's row image; ``now`` in seconds. Optional fields are null in the share of rows that their chance leaves out."""
    iso = lambda s: F.date_format(F.timestamp_seconds(s), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    created = F.lit(now) - draws.number("createdDate", YEAR)
    fleet = draws.one_of("customerType", ["Individual", "Fleet"])
    worked = created + (draws.number("lastTimeOrderWorked", 10_000) * (F.lit(now) - created) / 10_000).cast("long")
    more = F.when(draws.chance("locationIds", 50), F.array(draws.uuid("location 2"))).otherwise(F.array().cast("array<string>"))
    fields = {
        "id": F.concat(F.lit("customer"), draws.row.cast("string")), "companyId": company, "locationIds": F.concat(F.array(location), more), "customerType": fleet,
        "firstName": draws.named("firstName", "FirstName"), "lastName": draws.named("lastName", "LastName"), "email": F.concat(draws.named("email", "user", 10_000), F.lit("@example.com")),
        "phone": F.concat(F.lit("555-"), F.lpad(draws.number("phone", 10_000_000).cast("string"), 7, "0")), "taxExempt": draws.chance("taxExempt", 20), "marketingOptIn": draws.chance("marketingOptIn", 30),
        "orderCount": draws.number("orderCount", 100), "vehicleCount": draws.number("vehicleCount", 20), "discountPercent": draws.number("discountPercent", 2500) / 100, "paymentTermId": draws.uuid("paymentTermId"),
        "createdDate": iso(created), "updatedDate": iso(F.lit(now)), "dotNumber": F.when(fleet == "Fleet", F.lpad(draws.number("dotNumber", 1_000_000).cast("string"), 6, "0")),
        "lastTimeOrderWorked": F.when(draws.chance("lastTimeOrderWorked", 70), iso(worked)), "meta": F.struct(F.lit("generated").alias("source"), F.lit(now).alias("timestamp")),
        "labels": F.array(F.struct(draws.named("label", "Label").alias("name"))),
    }
    return F.struct(*[c.alias(n) for n, c in fields.items()])


def customer_updates(rows: DataFrame, row: str, seed: int, now: int, companies: int = 4, shift_days: int = 0, tenant: tuple[str, str] | None = None) -> DataFrame:
    """Wire events, one an input row: UPDATEs of generated customers that change name and mail. ``row`` is a column of whole numbers."""
    draws, now = Draws(seed, F.col(row)), now + shift_days * 86_400
    company = F.lit(tenant[0]) if tenant else draws.named("companyId", "company", companies)
    location = F.lit(tenant[1]) if tenant else draws.uuid("location 1")
    image = customer(draws, now, company, location)
    values = {
        "operation": F.lit(UPDATE), "id": F.md5(F.concat(F.lit(f"{seed}:"), F.col(row).cast("string")).cast("binary")), "table": F.lit("customer"), "key": F.array(F.concat(F.lit("customer"), F.col(row).cast("string"))),
        "modelVersion": F.lit("v1"), "companyId": company, "locationId": location, "userId": draws.named("userId", "user"), "after": F.to_json(image), "diff": F.array(*map(F.lit, ["firstName", "lastName", "email"])),
        "timestamp": F.lit(now * 1000).cast("long"), "mvccTimestamp": (F.lit(now * 1_000_000_000).cast("long") + F.col(row)).cast("string"), "imported": F.lit(False),
    }
    return rows.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in EVENT])


def generate(spark: SparkSession, n: int, seed: int, now: int, **more) -> DataFrame:
    """``n`` events, made by as many tasks as the session has."""
    return customer_updates(spark.range(n), "id", seed, now, **more)
