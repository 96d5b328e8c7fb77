"""Reading the payload of signed tokens. The signature is not checked."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the identity type that marks a person.
USER_IDENTITY = "User"


def token_payload(token: Column) -> Column:
    """The JSON text of the middle part of ``header.payload.signature``, NULL when it cannot be decoded."""
    body = F.translate(F.get(F.split(token, r"\."), F.lit(1)), "-_", "+/")
    padded = F.rpad(body, (F.ceil(F.length(body) / 4) * 4).cast("int"), "=")
    return F.try_validate_utf8(F.try_to_binary(padded, F.lit("base64")).cast("string"))


def token_claim(token: Column, claim: str) -> Column:
    return F.try_variant_get(F.try_parse_json(token_payload(token)), f"$.{claim}", "string")


def is_service_identity(token: Column) -> Column:
    """True unless the token says its owner is a person; NULL for no token and for one that cannot be read."""
    readable = F.try_parse_json(token_payload(token)).isNotNull()
    return F.when(readable, ~token_claim(token, "idtyp").eqNullSafe(USER_IDENTITY))
