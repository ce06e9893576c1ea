"""Distinguished names and cell names."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def managed_element(dn: Column) -> Column:
    """First two levels of a slash-separated name."""
    return F.substring_index(dn, "/", 2)


def relative_name(dn: Column, element: Column) -> Column:
    """The name below its element; null if it is not below it."""
    below = F.startswith(dn, F.concat(element, F.lit("/")))
    return F.when(below, F.right(dn, F.length(dn) - F.length(element) - 1))


def cell_name_of(dn: Column) -> Column:
    """The cell that a relation belongs to: its name up to the relation's own level."""
    return F.regexp_replace(dn, r"([,/])[A-Za-z]*Relation[=-].*$", "")


def dn_under(child: Column, parent: Column) -> Column:
    """The parent itself, or a name below it in either separator."""
    return (child == parent) | F.startswith(child, F.concat(parent, F.lit(","))) | F.startswith(child, F.concat(parent, F.lit("/")))


def ancestors(dn: Column) -> Column:
    """Array of the name itself and every name that it lies below: its prefixes up to each
    ',' and '/'.  A name has few levels, so a containment join becomes one on equality."""
    levels = F.split(dn, "(?=[,/])")
    above = F.transform(F.sequence(F.lit(1), F.size(levels)), lambda i: F.array_join(F.slice(levels, 1, i), ""))
    # a name that begins with a separator also lies below the empty one
    return F.when(dn.rlike("^[,/]"), F.concat(F.array(F.lit("")), above)).otherwise(above)


def site_of(cell: Column) -> Column:
    return F.split_part(cell, F.lit("_"), F.lit(1))


def relation_source(label: Column) -> Column:
    return F.split_part(label, F.lit("->"), F.lit(1))


def relation_target(label: Column) -> Column:
    return F.split_part(label, F.lit("->"), F.lit(2))


#: Resource blocks for each channel bandwidth in MHz.
RESOURCE_BLOCKS = {1.4: 6, 3.0: 15, 5.0: 25, 10.0: 50, 15.0: 75, 20.0: 100}


def n_rb(bandwidth_mhz: Column) -> Column:
    out = F.lit(None).cast("int")
    for mhz, n in RESOURCE_BLOCKS.items():
        out = F.when(bandwidth_mhz == mhz, n).otherwise(out)
    return out
