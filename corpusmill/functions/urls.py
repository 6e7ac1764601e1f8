"""Hosts, domains and sites of urls as native expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: scheme://user@host:port/... with the host, without its port, as group 1.
HOST_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)"


def host(url: Column) -> Column:
    """Lower-case host of a url without user and port; null if there is none."""
    found = F.lower(F.regexp_extract(url, HOST_PATTERN, 1))
    return F.when(found != "", found)


def trim_blanks(text: Column) -> Column:
    """text without white space (no-break spaces included) at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def domain_of(domain: Column, url: Column) -> Column:
    """The declared domain without outer blanks in lower case; if null or empty, the url's host."""
    declared = F.lower(trim_blanks(domain))
    return F.when(declared != "", declared).otherwise(host(url))


def site_of(url: Column, source: Column) -> Column:
    """Host of the url without one leading ``www.`` or ``m.``; the source if url is null."""
    return F.when(url.isNull(), source).otherwise(F.regexp_replace(host(url), r"^(?:www\.|m\.)", ""))


def has_public_suffix(name: Column) -> Column:
    """False for hosts that are bare names or IP addresses."""
    return name.contains(".") & ~name.rlike(r"^\d+(\.\d+)+$") & ~name.startswith("[")


def fqdn(url: Column) -> Column:
    """Full host name with sub-domain; '' for null, hosts without a dot, and IP addresses."""
    name = host(url)
    return F.coalesce(F.when(has_public_suffix(name), name), F.lit(""))
