import pytest

from tandem.functions.template import (
    DEFAULT_FAILOVER_TEMPLATE,
    DEFAULT_RECOVERY_TEMPLATE,
    TemplateError,
    check_template,
)
from tandem.options import LookupOptions, OptionError

BASE = {"doris.jdbc-url": "jdbc:mysql://store:9030/dim"}
ALERTS = {
    **BASE,
    "lookup.alert.threshold": 5,
    "lookup.alert.kafka.bootstrap-servers": " a:9092,b:9092 ",
    "lookup.alert.kafka.topic": "alerts",
}


def parse(**more):
    return LookupOptions.from_dict({**BASE, **{k.replace("__", "."): v for k, v in more.items()}})


def test_defaults():
    o = LookupOptions.from_dict(BASE, "dim_account")
    assert (o.primary, o.standby, o.batch_size, o.batch_max_wait_ms) == ("hbase", "doris", 50, 5)
    assert (o.stats_interval_s, o.failover_log_interval_s, o.alert_threshold) == (360, 10, 0)
    assert (o.alert_acks, o.alert_cooldown_min, o.alert_recovery) == ("1", 3, True)
    assert (o.wide_table, o.jdbc_table) == ("dim_account", "dim_account")
    assert (o.wide_family, o.rowkey_delimiter, o.rowkey_encoding) == ("info", "|", "string")
    assert o.alert_message == DEFAULT_FAILOVER_TEMPLATE


def test_explicit_table_names_win():
    o = LookupOptions.from_dict({**BASE, "hbase.table-name": "ns:t", "doris.table-name": "db.t"}, "dim")
    assert (o.wide_table, o.jdbc_table) == ("ns:t", "db.t")


def test_primary_choice_gives_the_other_as_standby():
    o = LookupOptions.from_dict({**BASE, "lookup.primary": " DORIS "})
    assert (o.primary, o.standby) == ("doris", "hbase")


@pytest.mark.parametrize(
    "options, text",
    [
        ({"lookup.primary": "redis"}, "lookup.primary"),
        ({"hbase.rowkey.encoding": "binary"}, "rowkey.encoding"),
        ({"hbase.security.authentication": "kerberbos"}, "authentication"),
        ({"hbase.rpc.protection": "none"}, "protection"),
        ({"lookup.timeout": 0}, "lookup.timeout"),
        ({"lookup.timeout": "soon"}, "lookup.timeout"),
        ({"lookup.batch.size": 0}, "batch.size"),
        ({"lookup.batch.max-wait": -1}, "max-wait"),
        ({"lookup.timeout": 500, "lookup.batch.max-wait": 500}, "max-wait"),
        ({"lookup.timeout": 500, "hbase.rpc.timeout": 500}, "rpc.timeout"),
        ({"lookup.timeout": 500, "doris.connect.timeout": 500}, "connect.timeout"),
        ({"lookup.timeout": 250}, "lookup.timeout"),
        ({"lookup.timeout": 1000, "doris.connect.timeout": 249}, "connect.timeout"),
        ({"lookup.timeout": 1000, "table.exec.async-lookup.timeout": "1s"}, "async-lookup.timeout"),
        ({"doris.query.timeout": -1}, "query.timeout"),
        ({"lookup.stats.log-interval": -1}, "stats.log-interval"),
        ({"lookup.failover.log-interval": -1}, "failover.log-interval"),
        ({"lookup.alert.threshold": -1}, "alert.threshold"),
        ({"lookup.alert.threshold": 10}, "bootstrap-servers"),
        ({"lookup.alert.threshold": 10, "lookup.alert.kafka.bootstrap-servers": "a:1"}, "topic"),
        ({"doris.pool.size": 0}, "pool.size"),
        ({"doris.query.timeout": -1, "lookup.batch.size": 0}, "batch.size.*; .*query.timeout|query.timeout.*; .*batch.size|batch.size"),
        ({"no.such.option": 1}, "no.such.option"),
        ({"doris.jdbc-url": " "}, "jdbc-url"),
        ({"hbase.security.authentication": "kerberos", "hbase.client.keytab.file": "/k"}, "keytab"),
        (
            {
                "hbase.security.authentication": "kerberos",
                "hbase.client.keytab.file": "/k",
                "hbase.client.kerberos.principal": "hbase/_HOST@R",
            },
            "_HOST",
        ),
    ],
)
def test_rejected(options, text):
    with pytest.raises(OptionError, match=text):
        LookupOptions.from_dict({**BASE, **options})


@pytest.mark.parametrize(
    "options, text",
    [
        ({"lookup.alert.kafka.acks": "ALL_ISR"}, "acks"),
        ({"lookup.alert.cooldown": -1}, "cooldown"),
        ({"lookup.alert.retry.max": -1}, "retry.max"),
        ({"lookup.alert.retry.backoff-ms": -1}, "backoff"),
        ({"lookup.alert.retry.backoff-ms": 900, "lookup.alert.retry.backoff-max-ms": 800}, "backoff-max"),
        ({"lookup.alert.kafka.max-block-ms": 0}, "max-block-ms"),
        ({"lookup.alert.kafka.delivery-timeout-ms": 4000}, "delivery-timeout"),
        ({"lookup.alert.kafka.retries": -1}, "retries"),
        ({"lookup.alert.spool.dir": "/d", "lookup.alert.spool.max-bytes": -1}, "max-bytes"),
    ],
)
def test_rejected_alert_options(options, text):
    with pytest.raises(OptionError, match=text):
        LookupOptions.from_dict({**ALERTS, **options})


def test_alert_options_are_normalised():
    o = LookupOptions.from_dict({**ALERTS, "lookup.alert.kafka.acks": "ALL"})
    assert (o.alert_bootstrap, o.alert_topic, o.alert_acks) == ("a:9092,b:9092", "alerts", "all")


@pytest.mark.parametrize("deadline, derived", [(1000, (800, 1000, 300)), (300, (240, 500, 250))])
def test_client_timeouts_follow_an_explicit_deadline(deadline, derived):
    o = LookupOptions.from_dict({**BASE, "lookup.timeout": deadline})
    assert (o.wide_rpc_timeout_ms, o.wide_operation_timeout_ms, o.jdbc_connect_timeout_ms) == derived


def test_explicit_client_timeouts_win():
    o = LookupOptions.from_dict(
        {
            **BASE,
            "lookup.timeout": 1000,
            "hbase.rpc.timeout": 250,
            "hbase.client.operation.timeout": 1500,
            "doris.connect.timeout": 300,
        }
    )
    assert (o.wide_rpc_timeout_ms, o.wide_operation_timeout_ms, o.jdbc_connect_timeout_ms) == (250, 1500, 300)


def test_query_timeout_follows_the_deadline_when_unset():
    assert LookupOptions.from_dict({**BASE, "lookup.timeout": 1000}).jdbc_query_timeout_effective_s == 1
    assert LookupOptions.from_dict({**BASE, "lookup.timeout": 20000}).jdbc_query_timeout_effective_s == 16
    assert LookupOptions.from_dict({**BASE, "doris.query.timeout": 7}).jdbc_query_timeout_effective_s == 7


def test_explicit_option_beats_property_of_the_same_name():
    passed = {"properties.hbase.security.authentication": "Kerberos", "properties.hbase.rpc.protection": "privacy"}
    o = LookupOptions.from_dict({**BASE, **passed})
    assert (o.wide_authentication, o.wide_rpc_protection) == ("kerberos", "privacy")
    o = LookupOptions.from_dict({**BASE, **passed, "hbase.security.authentication": "simple"})
    assert o.wide_authentication == "simple"
    assert o.wide_properties["hbase.rpc.protection"] == "privacy"


def test_kafka_properties_are_kept():
    o = LookupOptions.from_dict({**ALERTS, "lookup.alert.kafka.properties.security.protocol": "SASL_SSL"})
    assert o.kafka_properties == {"security.protocol": "SASL_SSL"}


def test_options_without_effect_are_ignored():
    assert LookupOptions.from_dict({**BASE, "doris.pool.min-idle": 99, "lookup.alert.kafka.queue-capacity": 0}) == LookupOptions.from_dict(BASE)


def test_every_violation_is_reported():
    with pytest.raises(OptionError) as error:
        LookupOptions(batch_size=0, jdbc_query_timeout_s=-1, wide_rpc_timeout_ms=10**9)
    assert all(part in str(error.value) for part in ("lookup.batch.size", "doris.query.timeout", "hbase.rpc.timeout"))


def test_long_names_stay_apart():
    one, other = (LookupOptions(table_name="t" * 300 + end).client_id() for end in "ab")
    assert one != other and len(one) == len(other) == 180


def test_client_id_is_safe():
    assert LookupOptions(table_name="a b").client_id("1/4") == "lookup-alert-a_b-1_4"
    assert LookupOptions(alert_client_id=" mine ").client_id("1/4") == "mine"


def test_templates():
    check_template(DEFAULT_FAILOVER_TEMPLATE)
    check_template(DEFAULT_RECOVERY_TEMPLATE)
    check_template('[{"table":"${table}"}]')
    for bad, text in [
        ('{"n":${consecutvie}}', "consecutvie"),
        ("primary down ${consecutive}", "JSON"),
        ('{"n":${x', "not closed"),
        ("   ", "blank"),
        (None, "blank"),
    ]:
        with pytest.raises(TemplateError, match=text):
            check_template(bad)


def test_template_is_checked_even_when_alerts_are_off():
    with pytest.raises(TemplateError, match="consecutvie"):
        LookupOptions.from_dict({**BASE, "lookup.alert.kafka.message": '{"n":${consecutvie}}'})
