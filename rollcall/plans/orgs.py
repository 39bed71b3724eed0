"""Organizations: district ownership, districts, schools."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dedupe import first_by, row_pluck
from ..operators.joins import seed
from ..operators.reshape import crosswalk_values, pivot_values
from .custom import add_custom_columns, add_extensions, extension_names
from .registry import dataset


@dataset("bld_tenant_lea_ownership", grain=("tenant_code", "k_lea"))
def tenant_lea_ownership(wh) -> DataFrame:
    """A tenant owns a district iff it owns a calendar at one of its schools."""
    cal = wh("stg_ef3__calendars").select("tenant_code", "k_school")
    sch = wh("stg_ef3__schools").select("tenant_code", "k_school", "k_lea")
    return cal.join(sch, ["tenant_code", "k_school"]).select("tenant_code", "k_lea").distinct()


@dataset("dim_lea", grain=("k_lea",))
def dim_lea(wh) -> DataFrame:
    """Districts that their tenant owns (J1 on ownership)."""
    lea = wh("stg_ef3__local_education_agencies")
    own = wh("bld_tenant_lea_ownership")
    address = current_address(wh, "stg_ef3__local_education_agencies__addresses", "k_lea")
    esc = ["k_esc"] if wh.config.enabled("esc") else []
    return lea.join(own, ["tenant_code", "k_lea"], "left_semi").join(address, "k_lea", "left").select(
        "k_lea", *esc, "tenant_code", "lea_id", "lea_name", "lea_category", *ADDRESS)


ADDRESS = ("address_type", "street_address", "city", "postal_code")


def current_address(wh, addresses: str, key: str) -> DataFrame:
    """R2: of the addresses that haven't ended the Physical one, else the first type alphabetically."""
    return row_pluck(wh(addresses), key, "address_type", "Physical", where=F.col("address_end_date").isNull()).select(key, *ADDRESS)


@dataset("bld_school_address", grain=("k_school",))
def school_address(wh) -> DataFrame:
    return current_address(wh, "stg_ef3__schools__addresses", "k_school")


@dataset("bld_wide_ids_school", grain=("tenant_code", "k_school"))
def wide_ids_school(wh) -> DataFrame:
    """X1 + S11: identification codes pivoted to ``{id_name}_school_code``; the
    column list comes from the crosswalk, codes without a crosswalk entry drop."""
    xw = seed(wh("xwalk_id_types_ed_org"))
    ids = wh("stg_ef3__schools__identification_codes").join(xw, "id_system")
    names = crosswalk_values(xw, "id_name")
    return pivot_values(ids, ["tenant_code", "k_school"], "id_name", names, "id_code", agg="min",
                        suffix="_school_code")


@dataset("dim_school", grain=("k_school",))
def dim_school(wh) -> DataFrame:
    """Schools of known districts (J1), with the district's name and id, networks,
    current address and wide id codes (J2)."""
    sch = add_extensions(wh, "stg_ef3__schools", wh("stg_ef3__schools"))
    lea = wh("dim_lea").select("k_lea", "lea_name", "lea_id")
    ids = wh("bld_wide_ids_school").drop("tenant_code")
    networks = wh("bld_wide_school_network_assoc").drop("tenant_code")
    out = (sch.join(lea, "k_lea").join(wh("bld_school_address"), "k_school", "left").join(ids, "k_school", "left")
           .join(networks, "k_school", "left")
           .select("k_school", "k_lea", *[c for c in networks.columns if c != "k_school"], "tenant_code", "school_id",
                   *[c for c in ids.columns if c != "k_school"], "school_name", "lea_name", "lea_id", "school_category", *ADDRESS,
                   *extension_names(wh, "stg_ef3__schools")))
    return add_custom_columns(wh, "dim_school", out, ["k_school"])


@dataset("dim_network", grain=("k_network",))
def dim_network(wh) -> DataFrame:
    """P1 projection of networks."""
    return wh("stg_ef3__education_organization_networks").select(
        "k_network", "tenant_code", "network_id", "network_name", "network_purpose")


@dataset("bld_wide_school_network_assoc", grain=("k_school", "tenant_code"))
def wide_school_network_assoc(wh) -> DataFrame:
    """Latest association per (school, network purpose), open end
    dates first, then pivoted to ``k_network__{type}`` through the crosswalk."""
    a = wh("stg_ef3__education_organization_network_associations")
    j = a.join(wh("dim_network").select("k_network", "network_purpose"), "k_network")
    d = first_by(j, ["k_school", "network_purpose"], [
        ("end_date", "desc nulls first"), ("begin_date", "desc nulls first"), ("k_network", "asc nulls first")])
    xw = seed(wh("xwalk_network_association_types")).filter(F.col("association_type") == "school")
    d = d.join(xw, "network_purpose")
    types = crosswalk_values(xw, "network_type")
    return pivot_values(d, ["k_school", "tenant_code"], "network_type", types, "k_network", agg="min",
                        prefix="k_network__")


@dataset("dim_esc", grain=("k_esc",))
def dim_esc(wh) -> DataFrame:
    """Service centers with their chosen address: Physical if present, else first alphabetically."""
    e = wh("stg_ef3__education_service_centers")
    return e.join(current_address(wh, "stg_ef3__education_service_centers__addresses", "k_esc"), "k_esc", "left")
