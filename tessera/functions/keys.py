"""Key-layout expressions of the single-table model.

Entities share one table and are told apart by the prefix of PK:
users ``USER#<id>`` / ``METADATA``, tasks ``TASK#<user>`` / ``TASK#<task>``,
idempotency keys ``IDEMPOTENCY#<request>`` / ``METADATA``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the key layout (must equal the stored keys).
USER_PREFIX = "USER#"
TASK_PREFIX = "TASK#"
IDEMPOTENCY_PREFIX = "IDEMPOTENCY#"
METADATA_SK = "METADATA"
NONE_KEY = "none"
ENTITY_TYPES = ("USER", "TASK", "IDEMPOTENCY", "UNKNOWN")


def entity_type(pk: Column) -> Column:
    """USER / TASK / IDEMPOTENCY by PK prefix, else UNKNOWN (null PK too)."""
    return (F.when(pk.startswith(USER_PREFIX), F.lit("USER"))
            .when(pk.startswith(TASK_PREFIX), F.lit("TASK"))
            .when(pk.startswith(IDEMPOTENCY_PREFIX), F.lit("IDEMPOTENCY"))
            .otherwise(F.lit("UNKNOWN")))


def strip_prefix(c: Column, prefix: str, anchored: bool = False) -> Column:
    """Remove ``prefix`` from a key.

    The batch jobs remove *every* occurrence (``TASK#a#TASK#b`` -> ``a#b``);
    that is the default.  ``anchored=True`` removes only a leading one.
    """
    pattern = ("^" if anchored else "") + prefix.replace("#", "\\#")
    return F.regexp_replace(c, pattern, "")


def key_part(c: Column, idx: int, sep: str = "#") -> Column:
    """The ``idx``-th (0-based) part of a separated key, null when absent."""
    return F.get(F.split(c, sep if sep != "|" else "\\|"), idx)


def derive_ids(pk: Column, sk: Column, etype: Column) -> tuple[Column, Column]:
    """(user_id, task_id) as the silver job derives them (PRJ-06)."""
    user_id = (F.when(etype == "USER", strip_prefix(pk, USER_PREFIX))
               .when(etype == "TASK", strip_prefix(pk, TASK_PREFIX))
               .otherwise(F.lit(None).cast("string")))
    task_id = F.when(etype == "TASK", strip_prefix(sk, TASK_PREFIX)).otherwise(F.lit(None).cast("string"))
    return user_id, task_id


def task_keys(user_id: Column, task_id: Column, status: Column, priority: Column,
              category: Column, due_date: Column) -> dict[str, Column]:
    """PK, SK and the four index keys of a task item (PRJ-14).

    A missing due date or category is written as the literal ``none``.
    """
    uid = user_id.cast("string")
    tid = task_id.cast("string")
    user_key = F.concat(F.lit(USER_PREFIX), uid)
    return {
        "PK": F.concat(F.lit(TASK_PREFIX), uid),
        "SK": F.concat(F.lit(TASK_PREFIX), tid),
        "GSI1PK": user_key,
        "GSI1SK": F.concat_ws("#", F.lit("STATUS"), status, tid),
        "GSI2PK": user_key,
        "GSI2SK": F.concat_ws("#", F.lit("DUEDATE"), F.coalesce(due_date, F.lit(NONE_KEY)), tid),
        "GSI3PK": user_key,
        "GSI3SK": F.concat_ws("#", F.lit("PRIORITY"), priority, tid),
        "GSI4PK": user_key,
        "GSI4SK": F.concat_ws("#", F.lit("CATEGORY"), F.coalesce(category, F.lit(NONE_KEY)), tid),
    }


def _blank_to_null(c: Column) -> Column:
    return F.when(F.length(c) > 0, c)


def request_id(headers: Column, user_id: Column, fallback: Column | None = None) -> Column:
    """Request id of a request (PRJ-16).

    First non-empty of the idempotency key header, X-Request-ID,
    X-Amzn-RequestId, then ``fallback`` (a fresh uuid by default); prefixed
    ``<user>:`` when the user is known.  Header names are matched as given.
    """
    base = F.coalesce(
        _blank_to_null(headers.getItem("Idempotency-Key")),
        _blank_to_null(headers.getItem("X-Request-ID")),
        _blank_to_null(headers.getItem("X-Amzn-RequestId")),
        fallback if fallback is not None else F.expr("uuid()"),
    )
    return F.when(_blank_to_null(user_id).isNotNull(), F.concat_ws(":", user_id, base)).otherwise(base)


def request_scope_ok(rid: Column, expected_user: Column) -> Column:
    """True when a request id belongs to ``expected_user`` (FIL-20).

    No expected user -> true; no colon in the id -> false; otherwise the part
    before the first colon must equal the user.
    """
    return (F.when(expected_user.isNull() | (expected_user == ""), F.lit(True))
            .when(rid.contains(":"), F.split(rid, ":").getItem(0) == expected_user)
            .otherwise(F.lit(False)))


# Fixed values (request format): claim names sub, email, name,
# cognito:username; header names Idempotency-Key, X-Request-ID, X-Amzn-RequestId.


def identity_from_claims(request_context: Column) -> Column:
    """User identity from a request's authorizer claims (PRJ-15).

    HTTP-API claims (``authorizer.jwt.claims``) first; the REST form
    (``authorizer.claims``) only when the first is absent or empty.  Name
    falls back to ``cognito:username`` then to the email.  ``valid`` is false
    when the id or the email is missing.
    """
    v2 = F.try_variant_get(request_context, "$.authorizer.jwt.claims", "map<string,string>")
    v1 = F.try_variant_get(request_context, "$.authorizer.claims", "map<string,string>")
    claims = F.when(F.coalesce(F.size(v2), F.lit(0)) > 0, v2).otherwise(v1)
    uid = _blank_to_null(claims.getItem("sub"))
    email = _blank_to_null(claims.getItem("email"))
    name = F.coalesce(_blank_to_null(claims.getItem("name")),
                      _blank_to_null(claims.getItem("cognito:username")), email)
    return F.struct(uid.alias("user_id"), email.alias("email"), name.alias("name"),
                    (uid.isNotNull() & email.isNotNull()).alias("valid"))
