"""Options of a two-store lookup: parsing, defaults, derived time-outs, cross checks (group G)."""

from __future__ import annotations

import dataclasses
import hashlib
import math
import re
from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Any

from tandem.functions.template import (
    DEFAULT_FAILOVER_TEMPLATE,
    DEFAULT_RECOVERY_TEMPLATE,
    check_template,
)

# The smallest and largest derived connect time-out, the smallest derived
# operation time-out (ms), and the share of the deadline given to a store client.
CONNECT_TIMEOUT_MIN_MS = 250
CONNECT_TIMEOUT_MAX_MS = 300
OPERATION_TIMEOUT_MIN_MS = 500
CLIENT_SHARE_OF_DEADLINE = 0.8

NAME_DIGEST = 16

WIDE_PROPERTY_PREFIX = "properties."
KAFKA_PROPERTY_PREFIX = "lookup.alert.kafka.properties."


class OptionError(ValueError):
    """An option is unknown, malformed, or contradicts another one."""


# Fixed names of options that a table declaration may carry and that have nothing to act on here: pools,
# queues and log-ins of client libraries. They are accepted and ignored.
IGNORED = frozenset(
    {
        "lookup.alert.kafka.queue-capacity",
        "lookup.alert.kafka.close-timeout-ms",
        "doris.pool.min-idle",
        "doris.pool.idle-timeout",
        "doris.pool.max-lifetime",
        "doris.pool.validation-timeout",
        "hbase.kerberos.krb5.conf",
    }
)


def _option(key: str, default: Any, kind: type = str, least: int | None = None):
    """An option with its dotted name and, for numbers, the least value it may have."""
    return field(default=default, metadata={"key": key, "kind": kind, "least": least})


@dataclass(frozen=True)
class LookupOptions:
    """All options of one dimension.

    ``table_name`` is the declared name of the dimension. The two stores are named by
    ``stores``; ``primary`` picks one of them and the other becomes the standby.
    """

    table_name: str = "dim"
    stores: tuple[str, str] = ("hbase", "doris")

    # Option names and defaults of a table declaration, down to the client properties.

    # routing, deadline, batching
    primary: str = _option("lookup.primary", "")
    deadline_ms: int = _option("lookup.timeout", 30_000, int, least=1)
    operator_timeout_ms: int = _option("table.exec.async-lookup.timeout", 180_000, int)
    batch_size: int = _option("lookup.batch.size", 50, int, least=1)
    batch_max_wait_ms: int = _option("lookup.batch.max-wait", 5, int, least=0)

    # statistics and log lines
    stats_interval_s: int = _option("lookup.stats.log-interval", 360, int, least=0)
    failover_log_interval_s: int = _option("lookup.failover.log-interval", 10, int, least=0)

    # alerts
    alert_threshold: int = _option("lookup.alert.threshold", 0, int, least=0)
    alert_bootstrap: str = _option("lookup.alert.kafka.bootstrap-servers", "")
    alert_topic: str = _option("lookup.alert.kafka.topic", "")
    alert_message: str = _option("lookup.alert.kafka.message", DEFAULT_FAILOVER_TEMPLATE)
    alert_recovery_message: str = _option("lookup.alert.recovery.message", DEFAULT_RECOVERY_TEMPLATE)
    alert_acks: str = _option("lookup.alert.kafka.acks", "1")
    alert_cooldown_min: int = _option("lookup.alert.cooldown", 3, int, least=0)
    alert_recovery: bool = _option("lookup.alert.recovery", True, bool)
    alert_retry_max: int = _option("lookup.alert.retry.max", 2, int, least=0)
    alert_backoff_ms: int = _option("lookup.alert.retry.backoff-ms", 500, int, least=0)
    alert_backoff_max_ms: int = _option("lookup.alert.retry.backoff-max-ms", 5_000, int, least=0)
    alert_spool_dir: str = _option("lookup.alert.spool.dir", "")
    alert_spool_max_bytes: int = _option("lookup.alert.spool.max-bytes", 0, int, least=0)  # 0 = no cap
    alert_client_id: str = _option("lookup.alert.kafka.client-id", "")
    alert_max_block_ms: int = _option("lookup.alert.kafka.max-block-ms", 5_000, int, least=1)
    alert_request_timeout_ms: int = _option("lookup.alert.kafka.request-timeout-ms", 5_000, int, least=1)
    alert_delivery_timeout_ms: int = _option("lookup.alert.kafka.delivery-timeout-ms", 15_000, int, least=1)
    alert_client_retries: int = _option("lookup.alert.kafka.retries", 2, int, least=0)

    # wide-column store
    wide_table: str = _option("hbase.table-name", "")
    wide_quorum: str = _option("hbase.zookeeper.quorum", "")
    wide_port: str = _option("hbase.zookeeper.property.clientPort", "2181")
    wide_znode: str = _option("zookeeper.znode.parent", "/hbase")
    wide_family: str = _option("hbase.column-family", "info")
    rowkey_delimiter: str = _option("hbase.rowkey.delimiter", "|")
    rowkey_encoding: str = _option("hbase.rowkey.encoding", "string")
    wide_rpc_timeout_ms: int = _option("hbase.rpc.timeout", 300, int)
    wide_operation_timeout_ms: int = _option("hbase.client.operation.timeout", 500, int)
    wide_retries: int = _option("hbase.client.retries.number", 1, int)
    wide_authentication: str = _option("hbase.security.authentication", "simple")
    wide_rpc_protection: str = _option("hbase.rpc.protection", "authentication")
    wide_keytab: str = _option("hbase.client.keytab.file", "")
    wide_principal: str = _option("hbase.client.kerberos.principal", "")
    wide_region_principal: str = _option("hbase.regionserver.kerberos.principal", "")
    wide_master_principal: str = _option("hbase.master.kerberos.principal", "")

    # SQL store
    jdbc_url: str = _option("doris.jdbc-url", "")
    jdbc_table: str = _option("doris.table-name", "")
    jdbc_user: str = _option("doris.username", "root")
    jdbc_password: str = _option("doris.password", "")
    jdbc_driver: str = _option("doris.driver", "com.mysql.cj.jdbc.Driver")
    jdbc_query_timeout_s: int = _option("doris.query.timeout", 0, int, least=0)
    jdbc_connections: int = _option("doris.pool.size", 4, int, least=1)
    jdbc_connect_timeout_ms: int = _option("doris.connect.timeout", 300, int, least=CONNECT_TIMEOUT_MIN_MS)

    # client properties handed on unchanged
    wide_properties: Mapping[str, str] = field(default_factory=dict)
    kafka_properties: Mapping[str, str] = field(default_factory=dict)

    # how the lookup runs on Spark
    connect_bound_ms: int = 60_000  # for opening a store, which the deadline does not count
    snapshot_bytes: int = 64 * 1024 * 1024
    broadcast_bytes: int = 32 * 1024 * 1024
    max_in_keys: int = 1_000

    def __post_init__(self):
        self._fill_in()
        self._check()

    # ------------------------------------------------------------------ construction

    @classmethod
    def from_dict(
        cls, options: Mapping[str, Any], table_name: str = "dim", **overrides: Any
    ) -> "LookupOptions":
        """Build from dotted option names, as a table declaration spells them.

        ``overrides`` are attribute names (``stores=…``, ``snapshot_bytes=…``). The JDBC URL is
        the one option that has to be present, since without a reachable standby there is no
        failover.
        """
        known = {f.metadata["key"]: f for f in dataclasses.fields(cls) if f.metadata}
        values: dict[str, Any] = {}
        wide: dict[str, str] = {}
        kafka: dict[str, str] = {}
        unknown = []
        for key, raw in options.items():
            if key.startswith(KAFKA_PROPERTY_PREFIX):
                kafka[key[len(KAFKA_PROPERTY_PREFIX):]] = str(raw)
            elif key.startswith(WIDE_PROPERTY_PREFIX):
                wide[key[len(WIDE_PROPERTY_PREFIX):]] = str(raw)
            elif key in IGNORED:
                continue
            elif key in known:
                values[known[key].name] = _parse(key, raw, known[key].metadata["kind"])
            else:
                unknown.append(key)
        if unknown:
            raise OptionError(f"unknown options: {sorted(unknown)}")
        if not str(values.get("jdbc_url", "")).strip():
            raise OptionError("doris.jdbc-url is required")
        values.update(_from_properties(values, wide))
        if "deadline_ms" in values:
            values = {**_derived_timeouts(values), **values}
        return cls(
            table_name=table_name, wide_properties=wide, kafka_properties=kafka, **values, **overrides
        )

    def _set(self, name: str, value: Any) -> None:
        object.__setattr__(self, name, value)

    def _fill_in(self) -> None:
        if len(self.stores) != 2 or self.stores[0] == self.stores[1]:
            raise OptionError(f"exactly two different store names are needed, got {self.stores}")
        self._set("stores", tuple(self.stores))
        self._set("primary", _one_of("lookup.primary", self.primary or self.stores[0], self.stores))
        self._set("rowkey_encoding", _one_of("hbase.rowkey.encoding", self.rowkey_encoding, ("string", "typed")))
        self._set(
            "wide_authentication",
            _one_of("hbase.security.authentication", self.wide_authentication, ("simple", "kerberos")),
        )
        self._set(
            "wide_rpc_protection",
            _one_of(
                "hbase.rpc.protection", self.wide_rpc_protection, ("authentication", "integrity", "privacy")
            ),
        )
        self._set("alert_acks", self.alert_acks.strip().lower())
        for name in ("alert_bootstrap", "alert_topic", "alert_spool_dir", "alert_client_id"):
            self._set(name, getattr(self, name).strip())
        for name in ("wide_table", "jdbc_table"):
            if not getattr(self, name):
                self._set(name, self.table_name)

    # ------------------------------------------------------------------ derived values

    @property
    def standby(self) -> str:
        first, second = self.stores
        return second if self.primary == first else first

    @property
    def jdbc_query_timeout_effective_s(self) -> int:
        """Server-side bound of a JDBC statement: the explicit one, else 80 % of the deadline."""
        if self.jdbc_query_timeout_s:
            return self.jdbc_query_timeout_s
        return math.ceil(CLIENT_SHARE_OF_DEADLINE * self.deadline_ms / 1000)

    @property
    def alerts_on(self) -> bool:
        return self.alert_threshold > 0

    def client_id(self, subtask: str = "") -> str:
        """Client id of the alert producer: the explicit one, else table and subtask."""
        if self.alert_client_id:
            return self.alert_client_id
        name = "-".join(part for part in ("lookup-alert", self.table_name, subtask) if part)
        return safe_name(name, 180)

    def summary(self) -> str:
        """The options worth echoing once in a log line."""
        return (
            f"primary={self.primary} standby={self.standby} deadline={self.deadline_ms}ms "
            f"batch.size={self.batch_size} batch.max-wait={self.batch_max_wait_ms}ms "
            f"stats.interval={self.stats_interval_s}s failover.log-interval={self.failover_log_interval_s}s "
            f"alert.threshold={self.alert_threshold}"
        )

    # ------------------------------------------------------------------ checks

    def _check(self) -> None:
        """Report every bound and every rule that does not hold, at once."""
        wrong = []
        for option in dataclasses.fields(self):
            least = option.metadata.get("least")
            if least is not None and getattr(self, option.name) < least:
                wrong.append(f"{option.metadata['key']} must be at least {least}, got {getattr(self, option.name)}")
        for name in ("snapshot_bytes", "broadcast_bytes", "max_in_keys"):
            if getattr(self, name) < 0:
                wrong.append(f"{name} must be at least 0, got {getattr(self, name)}")
        rules = (*_RULES, *_ALERT_RULES) if self.alerts_on else _RULES
        wrong += [text for holds, text in rules if not holds(self)]
        if wrong:
            raise OptionError("; ".join(wrong))
        check_template(self.alert_message)
        check_template(self.alert_recovery_message)


# What options have to be to each other, in terms of what goes wrong otherwise.
_RULES = (
    (lambda o: o.operator_timeout_ms > o.deadline_ms, "table.exec.async-lookup.timeout ends a lookup before lookup.timeout can lead to the standby"),
    (lambda o: o.batch_max_wait_ms < o.deadline_ms, "lookup.batch.max-wait takes up the whole of lookup.timeout"),
    (lambda o: o.wide_rpc_timeout_ms < o.deadline_ms, "hbase.rpc.timeout leaves lookup.timeout no time for a second try"),
    (
        lambda o: o.jdbc_connect_timeout_ms < o.deadline_ms,
        f"doris.connect.timeout takes up the whole of lookup.timeout (derived, it is not below {CONNECT_TIMEOUT_MIN_MS}ms)",
    ),
    (
        lambda o: o.wide_authentication != "kerberos" or bool(o.wide_keytab.strip()) == bool(o.wide_principal.strip()),
        "hbase.client.keytab.file and hbase.client.kerberos.principal are of use only together",
    ),
    (
        lambda o: o.wide_authentication != "kerberos" or "_HOST" not in o.wide_principal,
        "hbase.client.kerberos.principal names no account while it holds _HOST",
    ),
)
_ALERT_RULES = (
    (lambda o: o.alert_bootstrap, "lookup.alert.threshold is set without lookup.alert.kafka.bootstrap-servers"),
    (lambda o: o.alert_topic, "lookup.alert.threshold is set without lookup.alert.kafka.topic"),
    (lambda o: o.alert_acks in ("0", "1", "-1", "all"), "lookup.alert.kafka.acks is none of 0, 1, -1, all"),
    (lambda o: o.alert_backoff_ms <= o.alert_backoff_max_ms, "lookup.alert.retry.backoff-max-ms is below the first pause"),
    (
        lambda o: o.alert_request_timeout_ms <= o.alert_delivery_timeout_ms,
        "lookup.alert.kafka.delivery-timeout-ms ends before a single request does",
    ),
)


def safe_name(text: str, length: int) -> str:
    """``text`` with everything but letters, digits, dot, underscore and dash replaced.

    A name beyond ``length`` ends in a digest of the whole of it, so that long names stay apart.
    """
    kept = re.sub(r"[^A-Za-z0-9._-]", "_", text)
    if len(kept) <= length:
        return kept
    return f"{kept[: length - NAME_DIGEST - 1]}-{hashlib.sha256(text.encode()).hexdigest()[:NAME_DIGEST]}"


def _parse(key: str, raw: Any, kind: type) -> Any:
    if kind is str:
        return "" if raw is None else str(raw)
    if kind is bool:
        if isinstance(raw, bool):
            return raw
        text = str(raw).strip().lower()
        if text not in ("true", "false"):
            raise OptionError(f"{key} must be true or false, got {raw!r}")
        return text == "true"
    text = str(raw).strip().lower()
    if key == "table.exec.async-lookup.timeout":
        text = str(_duration_ms(text))
    try:
        return int(text)
    except ValueError:
        raise OptionError(f"{key} must be a whole number, got {raw!r}") from None


def _duration_ms(text: str) -> str:
    units = {"ms": 1, "s": 1_000, "min": 60_000, "h": 3_600_000}
    for unit in ("ms", "min", "s", "h"):
        number = text.removesuffix(unit).strip()
        if text.endswith(unit) and number.isdigit():
            return str(int(number) * units[unit])
    return text


def _one_of(key: str, raw: str, allowed: tuple[str, ...]) -> str:
    folded = {name.lower(): name for name in allowed}
    value = (raw or "").strip().lower()
    if value not in folded:
        raise OptionError(f"{key} must be one of {', '.join(allowed)}, got {raw!r}")
    return folded[value]


def _from_properties(values: Mapping[str, Any], properties: Mapping[str, str]) -> dict[str, str]:
    """Pass-through properties that also have an option; the explicit option wins."""
    pairs = {
        "wide_authentication": ("hbase.security.authentication",),
        "wide_rpc_protection": ("hbase.rpc.protection",),
        "wide_keytab": ("hbase.client.keytab.file",),
        "wide_principal": ("hbase.client.kerberos.principal", "hbase.client.keytab.principal"),
    }
    found = {}
    for name, keys in pairs.items():
        if str(values.get(name, "")).strip():
            continue
        given = [properties[key].strip() for key in keys if properties.get(key, "").strip()]
        if given:
            found[name] = given[0]
    return found


def _derived_timeouts(values: Mapping[str, Any]) -> dict[str, int]:
    """Client time-outs that follow an explicit deadline."""
    deadline = values["deadline_ms"]
    share = math.floor(deadline * CLIENT_SHARE_OF_DEADLINE + 0.5)
    return {
        "wide_rpc_timeout_ms": max(1, share),
        "wide_operation_timeout_ms": max(OPERATION_TIMEOUT_MIN_MS, deadline),
        "jdbc_connect_timeout_ms": max(CONNECT_TIMEOUT_MIN_MS, min(CONNECT_TIMEOUT_MAX_MS, share)),
    }
