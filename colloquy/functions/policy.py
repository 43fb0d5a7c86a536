"""Rules on providers' targets and on names, as columns that hold the reason of a refusal or null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Providers that are programs rather than addresses.
CLI = ("codex_cli",)


def model_fault(model: Column) -> Column:
    blank = model.isNull() | (F.trim(model) == "")
    return F.when(blank, "model missing").when(model.rlike(r"[\x00-\x1f]"), "control characters")


def is_loopback(host: Column) -> Column:
    host = F.lower(F.trim(host))
    octet = r"(25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
    return host.isin("localhost", "::1") | host.rlike(rf"^127(\.{octet}){{3}}$")


def host_of(url: Column) -> Column:
    """The host of a URL without credentials, port and brackets; null where there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)
    authority = F.regexp_replace(authority, r"^.*@", "")
    host = F.when(authority.startswith("["), F.regexp_extract(authority, r"^\[([^\]]*)\]", 1)).otherwise(F.regexp_replace(authority, r":.*$", ""))
    return F.nullif(F.lower(host), F.lit(""))


def target_fault(provider: Column, target: Column, allow_remote: bool = False, allow_http: bool = False, allow_executable: bool = False) -> Column:
    """Why a provider may not be called at a target; null if it may."""
    provider, target = F.coalesce(F.lower(F.trim(provider)), F.lit("")), F.coalesce(F.trim(target), F.lit(""))
    scheme, host = F.lower(F.regexp_extract(target, r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1)), host_of(target)
    is_cli = provider.isin(*CLI)
    fault = F.when(provider == "", "provider missing").when(target == "", "target missing")
    fault = fault.when(is_cli & target.rlike(r"[\x00\n\r]"), "invalid characters")
    if allow_executable:
        safe = target.rlike(r"^/") | target.rlike(r"^[A-Za-z0-9._-]+$")
        fault = fault.when(is_cli & ~safe, "unsafe executable")
    else:
        fault = fault.when(is_cli & (target != "codex"), "custom executable")
    fault = fault.when(is_cli, F.lit(None).cast("string")).when(~scheme.isin("http", "https"), "scheme").when(host.isNull(), "host missing")
    if not allow_http:
        fault = fault.when(scheme == "http", "insecure http")
    if not allow_remote:
        fault = fault.when(~is_loopback(host), "off-box")
    return fault
