"""Signed verdicts: a compact RS256 token over the digest of the canonical payload."""

from __future__ import annotations

import base64
import hashlib
import json
import time
from typing import Protocol

from pyspark.sql import SparkSession

from veilframe.operators.messages import canonical_json


class SignatureError(ValueError):
    """A verdict that cannot be trusted."""


class Signer(Protocol):
    def sign(self, event_id: str, payload: dict) -> str: ...


def _b64(data: bytes) -> str:
    return base64.urlsafe_b64encode(data).rstrip(b"=").decode()


def _unb64(text: str) -> bytes:
    return base64.urlsafe_b64decode(text + "=" * (-len(text) % 4))


def payload_digest(payload: dict) -> str:
    return hashlib.sha256(canonical_json(payload).encode()).hexdigest()


class JvmSigner:
    """RS256 by the JVM's own providers, on the driver."""

    def __init__(self, spark: SparkSession, issuer: str, audience: str, subject: str, private_key=None):
        self.jvm, self.claims, self.private = spark._jvm, {"iss": issuer, "aud": audience, "sub": subject}, private_key

    @staticmethod
    def generate_keys(spark: SparkSession, bits: int = 2048):
        maker = spark._jvm.java.security.KeyPairGenerator.getInstance("RSA")
        maker.initialize(bits)
        pair = maker.generateKeyPair()
        return pair.getPrivate(), pair.getPublic()

    def sign(self, event_id: str, payload: dict) -> str:
        header = {"alg": "RS256", "typ": "JWT"}
        claims = self.claims | {"event_id": event_id, "payload_sha256": payload_digest(payload), "iat": int(time.time())}
        body = ".".join(_b64(canonical_json(x).encode()) for x in (header, claims))
        s = self.jvm.java.security.Signature.getInstance("SHA256withRSA")
        s.initSign(self.private)
        s.update(bytearray(body.encode()))
        return f"{body}.{_b64(bytes(s.sign()))}"


def verify(spark: SparkSession, token: str | None, public_key, message: dict, issuer: str, audience: str, subject: str) -> dict:
    """The claims, if algorithm, signature, parties, event and payload are all as they must be."""
    try:
        head, body, mark = (token or "").split(".")
        header, claims = json.loads(_unb64(head)), json.loads(_unb64(body))
    except ValueError as e:
        raise SignatureError("not a compact token") from e
    if header.get("alg") != "RS256":
        raise SignatureError(f"algorithm {header.get('alg')!r}")
    s = spark._jvm.java.security.Signature.getInstance("SHA256withRSA")
    s.initVerify(public_key)
    s.update(bytearray(f"{head}.{body}".encode()))
    try:
        valid = s.verify(bytearray(_unb64(mark)))
    except Exception as e:  # a mark of the wrong length raises in the JVM
        raise SignatureError("signature") from e
    if not valid:
        raise SignatureError("signature")
    expected = {"iss": issuer, "aud": audience, "sub": subject, "event_id": message["envelope"]["event_id"], "payload_sha256": payload_digest(message["payload"])}
    for claim, value in expected.items():
        if claims.get(claim) != value:
            raise SignatureError(claim)
    return claims
