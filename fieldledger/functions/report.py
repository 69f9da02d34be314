"""Report text of one incident, as column expressions over a wording template."""

from __future__ import annotations

from dataclasses import dataclass
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldledger import fixed_values as fv
from fieldledger.functions.casts import strip, whole_count
from fieldledger.functions.text import thousands


@dataclass(frozen=True)
class ReportTemplate:
    """Wording of the record. `{name}` marks the place of a column."""

    system: str = "You are an analyst who combines incident records with event activity."
    instruction: str = "Summarise the {label} incident recorded in {country} in {year}."
    header: str = "INCIDENT REPORT — {label} | {country} | {year}"
    lead: str = "A {label} incident was recorded in {country} in {year}, {casualties}."
    casualties: str = "with {kills} {deaths} and {wounds} wounded"
    one_death: str = "death"
    more_deaths: str = "deaths"
    no_casualties: str = "with no casualties"
    target: str = "Its target was {target}."
    weapon: str = "The weapon was {weapon}."
    group: str = "It was attributed to {group}."
    context_heading: str = "CONTEXT: "
    context: str = "The activity log holds {count} events for {country} in {year}."
    no_context: str = "The activity log holds no events for {country} in {year}."
    assessment_heading: str = "ASSESSMENT: "
    assessment: str = "The severity is {severity}; keep watching {country}."

    @property
    def header_opening(self) -> str:
        return self.header.split("{", 1)[0]


def fill(text: str, **columns: Column) -> Column:
    """Concatenation of the text with the columns in the place of their names."""
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(text):
        if literal:
            parts.append(F.lit(literal))
        if name:
            parts.append(columns[name].cast("string"))
    return F.concat(*parts) if parts else F.lit("")


def instruction_text(t: ReportTemplate, label: Column, country: Column, year: Column) -> Column:
    return fill(t.instruction, label=label, country=country, year=year)


def casualty_clause(t: ReportTemplate, kills: Column, wounds: Column) -> Column:
    """Deaths and wounded; the `none` wording only if neither is above zero."""
    deaths = F.when(kills == 1, t.one_death).otherwise(t.more_deaths)
    counted = fill(t.casualties, kills=kills, deaths=deaths, wounds=wounds)
    return F.when((kills > 0) | (wounds > 0), counted).otherwise(t.no_casualties)


def optional_clause(text: str, **column: Column) -> Column:
    """The sentence, or `''` where its column is NULL or empty."""
    (value,) = column.values()
    return F.when(value.isNotNull() & (value != ""), fill(text, **column)).otherwise("")


def attribution_clause(t: ReportTemplate, group: Column) -> Column:
    """The group as it is written, or `''` where it is blank or unknown after trimming."""
    named = group.isNotNull() & ~strip(group).isin("", fv.UNKNOWN)
    return F.when(named, fill(t.group, group=group)).otherwise("")


def context_clause(t: ReportTemplate, count: Column, country: Column, year: Column) -> Column:
    found = fill(t.context, count=thousands(count), country=country, year=year)
    return F.when(count > 0, found).otherwise(fill(t.no_context, country=country, year=year))


def severity_bucket(kills: Column) -> Column:
    steps = [F.when(kills >= least, name) for least, name in fv.SEVERITY_STEPS]
    return F.coalesce(*steps, F.lit(fv.SEVERITY_ELSE))


def report_text(
    t: ReportTemplate,
    *,
    label: Column,
    country: Column,
    year: Column,
    kills: Column,
    wounds: Column,
    target: Column,
    weapon: Column,
    group: Column,
    count: Column,
) -> Column:
    """All sections joined by line feeds; an empty clause leaves its blank line."""
    kills, wounds = whole_count(kills), whole_count(wounds)
    place = {"country": country, "year": year}
    return F.concat_ws(
        "\n",
        fill(t.header, label=F.upper(label), **place),
        F.lit(""),
        fill(t.lead, label=label, casualties=casualty_clause(t, kills, wounds), **place),
        optional_clause(t.target, target=target),
        optional_clause(t.weapon, weapon=weapon),
        attribution_clause(t, group),
        F.lit(""),
        F.concat(F.lit(t.context_heading), context_clause(t, count, country, year)),
        F.lit(""),
        F.concat(
            F.lit(t.assessment_heading),
            fill(t.assessment, severity=severity_bucket(kills), country=country),
        ),
    )
