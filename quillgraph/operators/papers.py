"""Sessional papers: what a paper is, and the series it belongs to, by ordered rules over its subject and title."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quillgraph.operators.lineage import cut

# Series, group and pattern, the first that fits counts.
SERIES = r"""
auditor_general | finance | auditor[- ]general
public_accounts | finance | public accounts
estimates | finance | \bestimates?\b.*(sums|service|year)|^estimates|supplementary estimates
gg_warrants | finance | governor[- ]general'?s? warrants|warrants issued
unforeseen | finance | unforeseen expenses
superannuation | finance | superannuat
banks_shareholders | finance | shareholders.*bank|bank.*shareholders
banks_unclaimed | finance | dividends remaining unpaid|unclaimed balances
banks_other | finance | ^(banks?|bank of|montreal bank|chartered banks)|\bbanks?\b.*(statement|return of)
insurance | finance | insurance
savings_banks | finance | savings? bank|dominion notes|provincial notes
trade_navigation | trade | trade and navigation|tables of the trade
trade_commerce | trade | department of trade and commerce
inland_revenue | trade | inland revenue
weights_measures | trade | weights,? measures
adulteration | trade | adulteration
customs | trade | ^customs|customs department
experimental_farms | agriculture | experimental farms?
archives | agriculture | archives
criminal_stats | agriculture | criminal statistics
mortuary_stats | agriculture | mortuary|vital statistics
dairy | agriculture | dairy commissioner
high_commissioner | agriculture | high commissioner
immigration | agriculture | immigra
census | agriculture | \bcensus\b
agriculture | agriculture | minister of agriculture|department of agriculture|^agriculture
exhibitions | agriculture | exhibition
post_office | works | postmaster[- ]general|^post office
public_works | works | minister of public works|department of public works|^public works
railway_statistics | works | railway statistics
canal_statistics | works | canal statistics|canals revenue
railways_canals | works | railways and canals
intercolonial | works | intercolonial
cpr | works | canadian pacific|pacific railway
railways_other | works | railway
canals_other | works | canal|harbou?r
steamboat_insp | marine | steamboat inspection|board of steamboat
fisheries | marine | department of fisheries|fisheries statements|fish-?breeding|fisheries of canada|fishing bount|^fisheries|fishery
marine_fisheries | marine | marine and fisheries|department of marine|^marine
harbour_comm | marine | harbou?r commissioners|trinity house
meteorology | marine | meteorolog
geological_survey | interior | geological
dominion_lands | interior | dominion lands|homestead|land regulations|public lands
interior | interior | department of the interior|minister of the interior|^interior
indian_affairs | interior | indian affairs|^indians?\b|indian (lands|reserves?|branch)
nwmp | interior | mounted police
nwt | interior | north[- ]west territor|half[- ]breed|rebellion|riel
yukon | interior | yukon|klondike
manitoba_bc | interior | manitoba|british columbia
civil_service_list | state | civil service list
civil_service | state | civil service
public_printing | state | public printing|printing and stationery
secretary_of_state | state | secretary of state
library | state | librar
penitentiaries | justice | penitentiar
justice | justice | minister of justice|^justice|judiciary|supreme court|exchequer|court
statutes | justice | statutes|disallowance|provincial (acts|legislation)|acts of the
elections | state | election
militia | defence | militia|defence
gg_messages | state | governor[- ]general transmits|message from his excellency|despatch
treaties_imperial | state | treaty|reciprocity|washington|imperial|newfoundland|colonial conference
"""
KINDS = r"""
return_to_order | return.{0,30}to an order|return to order|return.{0,20}order of the (house|senate)
return_to_address | return.{0,30}to an address|return to address|address of the (house|senate)
return_resolution | return.{0,40}(resolution|standing order)
message | ^message|transmits to the house
report_commission | royal commission|commissioners? appointed
correspondence | ^(copies of|copy of|papers|correspondence|further papers|additional papers)
statement | ^(statement|statements|list of|abstract|tables?)
report | ^(annual |\w+ annual |first |second |third |preliminary |summary )?report|^reports? of
"""
#: What parts a title's leading clause from the rest, and the series that a return to an order or address may be of.
CLAUSE = r"\s*APPENDIX|\s*SUPPLEMENT|:—|\.—|\s—|\.\s*Presented|Presented to|;\s*presented|\s###"
RETURNED = "gg_warrants unforeseen superannuation banks_shareholders banks_unclaimed cpr intercolonial immigration nwt yukon elections civil_service statutes".split()


def ruled(table: str) -> list[tuple[str, ...]]:
    """The rules of a table of lines: name, other fields, pattern; a bar parts fields where spaces are around it."""
    return [tuple(x.strip() for x in line.split(" | ")) for line in table.strip().splitlines()]


def plain(c: Column | str) -> Column:
    """A heading without asterisks, with single spaces, and without points, dashes and spaces at its ends; empty for null."""
    x = F.regexp_replace(F.replace(F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit("")), F.lit("*"), F.lit("")), r"\s+", " ")
    return F.trim(x, F.lit(" .—-"))


def fitting(text: Column, rules: list[tuple[str, ...]]) -> Column:
    """The names of all rules whose pattern is in the text, in rule order."""
    return F.filter(F.array(*[F.when(text.rlike(f"(?i){r[-1]}"), F.lit(r[0])) for r in rules]), lambda x: x.isNotNull())


def classified(rows: DataFrame, subject: str, title: str) -> DataFrame:
    """Add ``kind, series, contains`` to papers.

    The subject heading decides the series, else the title's leading clause, else the
    whole text; a return to an order or address goes by its subject, else by the
    whole, and only to a series that returns are made of.  ``contains`` lists every other series that the
    whole text speaks of.  No rule that fits gives a null series and the kind ``other``.
    The rules meet each distinct pair of subject and title once.
    """
    pair = rows.select(F.col(subject).alias("_subject"), F.col(title).alias("_title")).distinct()
    texts = cut(pair.withColumn("_s", plain("_subject")).withColumn("_t", plain("_title")))
    texts = texts.withColumn("_full", F.concat("_s", F.lit(" | "), "_t")).withColumn("_lead", F.get(F.split("_t", f"(?i){CLAUSE}"), F.lit(0)))
    series, kinds = ruled(SERIES), ruled(KINDS)
    for c in ("_s", "_lead", "_full"):
        texts = texts.withColumn(f"{c}_fit", fitting(F.col(c), series))
    kind = F.lit("other")
    for name, pattern in reversed(kinds):
        fits = F.col("_t").rlike(f"(?i){pattern}")
        fits = fits | F.col("_full").rlike(f"(?i){pattern}") if name in ("return_to_order", "return_to_address") else fits
        kind = F.when(fits, name).otherwise(kind)
    first = lambda c: F.get(F.col(f"{c}_fit"), F.lit(0))
    of_return = F.coalesce(first("_s"), first("_full"))
    texts = texts.withColumn("kind", kind)
    chosen = F.when(F.col("kind").isin("return_to_order", "return_to_address"), F.when(of_return.isin(*RETURNED), of_return)).otherwise(F.coalesce(first("_s"), first("_lead"), first("_full")))
    texts = texts.withColumn("series", chosen).withColumn("contains", F.filter("_full_fit", lambda x: ~x.eqNullSafe(F.col("series"))))
    said = texts.select("_subject", "_title", "kind", "series", "contains")
    return rows.join(said, F.col(subject).eqNullSafe(F.col("_subject")) & F.col(title).eqNullSafe(F.col("_title"))).drop("_subject", "_title")
