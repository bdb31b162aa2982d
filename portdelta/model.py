"""Record shapes: message envelopes and the published output record."""

from __future__ import annotations

from pyspark.sql import types as T

# Counter names as network elements send them.
INTERFACE_COUNTERS = [
    "carrier-transitions",
    "in-broadcast-pkts",
    "in-discards",
    "in-errors",
    "in-fcs-errors",
    "in-multicast-pkts",
    "in-octets",
    "in-pause-pkts",
    "in-pkts",
    "in-unicast-pkts",
    "in-unknown-proto-pkts",
    "in-unknown-protos",
    "last-clear",
    "out-broadcast-pkts",
    "out-discards",
    "out-errors",
    "out-multicast-pkts",
    "out-octets",
    "out-pause-pkts",
    "out-pkts",
    "out-unicast-pkts",
    "out-unknown-proto-pkts",
    "out-unknown-protos",
]

# Counters of the flat record, in output order.
FLAT_COUNTERS = [
    "in_broadcast_pkts",
    "in_discards",
    "in_errors",
    "in_fcs_errors",
    "in_multicast_pkts",
    "in_octets",
    "in_pause_pkts",
    "in_pkts",
    "in_unicast_pkts",
    "in_unknown_protos",
    "out_broadcast_pkts",
    "out_discards",
    "out_errors",
    "out_multicast_pkts",
    "out_octets",
    "out_pause_pkts",
    "out_pkts",
    "out_unicast_pkts",
    "out_unknown_protos",
]

# Counters published as deltas, and gauges published as their window maximum.
DELTA_COUNTERS = [
    "in_octets",
    "in_pkts",
    "in_multicast_pkts",
    "in_unicast_pkts",
    "in_discards",
    "in_errors",
    "in_broadcast_pkts",
    "out_octets",
    "out_pkts",
    "out_multicast_pkts",
    "out_unicast_pkts",
    "out_discards",
    "out_errors",
    "out_broadcast_pkts",
]
GAUGES = ["in_fcs_errors", "last_clear", "carrier_transitions"]

# Column order of the published record.
OUTPUT_COLUMNS = [
    "recordtype",
    "timestamp",
    "start_epochtime",
    "end_epochtime",
    "delta_time_ms",
    "devicename",
    "interface",
    "subinterface",
    "in_octets",
    "in_pkts",
    "in_multicast_pkts",
    "in_unicast_pkts",
    "in_discards",
    "in_errors",
    "in_broadcast_pkts",
    "out_octets",
    "out_pkts",
    "out_multicast_pkts",
    "in_fcs_errors",
    "out_unicast_pkts",
    "out_discards",
    "out_errors",
    "out_broadcast_pkts",
    "last_clear",
    "carrier_transitions",
]

# Text fields around the payload of a message.
MESSAGE_FIELDS = [
    "ucgMessage",
    "ucgSequenceNum",
    "ucgSource",
    "ucgTimestamp",
    "ucgTopic",
    "ucgType",
    "ucgYangTopic",
]

# Fields of a poll message and of one polled element.
POLL_FIELDS = [
    "finishTime",
    "vendor",
    "dataType",
    "startTime",
    "deviceName",
    "max_pdu_per_sec",
    "ifDescr",
    "loopback",
    "intervalTime",
    "ifAlias",
    "internalTopic",
    "pollerCID",
    "pollingInterval",
]
ELEMENT_FIELDS = [
    "oidTag",
    "ifIndex",
    "sysUpTime",
    "orient",
    "oid",
    "previousSysUpTime",
    "type",
    "value",
    "qosQueue",
    "delta_time_ms",
    "delta_counter",
    "delta_rate",
    "epoch_collected",
    "previousValue",
]


def struct_of(**fields: T.DataType | str) -> T.StructType:
    """Struct of nullable fields; ``_`` in a keyword stays as it is."""
    return struct_from(fields)


def struct_from(fields: dict[str, T.DataType | str]) -> T.StructType:
    out = T.StructType()
    for name, kind in fields.items():
        out = out.add(name, T.StringType() if kind == "string" else T.LongType() if kind == "long" else kind, True)
    return out


def map_to(value: T.DataType) -> T.MapType:
    return T.MapType(T.StringType(), value, True)


def counters_type(kind: str = "long") -> T.StructType:
    return struct_from({name: kind for name in INTERFACE_COUNTERS})


def interface_type(counters: T.StructType | None = None) -> T.StructType:
    """One interface with counters, status and sub-interfaces; absent parts parse as NULL."""
    counters = counters or counters_type()
    sub_state = struct_from(
        {"counters": counters, "ifindex": "string", "admin-status": "string", "oper-status": "string"}
    )
    sub = struct_of(index="string", state=sub_state)
    state = struct_from(
        {
            "counters": counters,
            "high-speed": "long",
            "admin-status": "string",
            "ifindex": "string",
            "oper-status": "string",
            "mtu": "string",
        }
    )
    return struct_of(name="string", state=state, subinterfaces=struct_of(subinterface=map_to(sub)))


def _message(payload: T.StructType) -> T.StructType:
    fields: dict[str, T.DataType | str] = {"ucgDeviceName": "string", "ucgJsonData": payload}
    fields.update({name: "string" for name in MESSAGE_FIELDS})
    return struct_from(fields)


def _device_payload() -> T.StructType:
    # Time is epoch nanoseconds, sent as a number or as text; text takes both.
    return struct_of(interfaces=struct_of(interface=map_to(interface_type())), timestamp="string")


ENVELOPE = _message(_device_payload())

_channel_state = struct_from(
    {
        "description": "string",
        "input-power": struct_of(instant=T.IntegerType()),
        "laser-bias-current": struct_of(instant=T.IntegerType()),
        "output-power": struct_of(instant=T.IntegerType()),
        "target-output-power": T.IntegerType(),
        "tx-laser": T.BooleanType(),
    }
)
_channels = struct_of(channel=map_to(struct_of(index="string", state=_channel_state)))
_component = struct_of(name="string", transceiver=struct_from({"physical-channels": _channels}))
OPTICS_ENVELOPE = _message(struct_of(components=struct_of(component=map_to(_component)), timestamp="long"))

# Counters and time (epoch milliseconds) arrive as text in this one.
SYSTEM_COUNTERS = [name.replace("_", "-") for name in DELTA_COUNTERS + GAUGES]
SYSTEM_INTERFACE = struct_of(
    name="string", state=struct_of(counters=struct_from({name: "string" for name in SYSTEM_COUNTERS}))
)


def _system(interfaces: T.DataType) -> T.StructType:
    return struct_of(
        system=struct_of(
            metaData=struct_of(ucgDeviceName="string", ucgSource="string", ucgType="string"),
            perf=struct_of(interfaces=struct_of(interface=interfaces)),
            timestamp="string",
        )
    )


SYSTEM_ENVELOPE = _system(map_to(SYSTEM_INTERFACE))
SYSTEM_LIST_ENVELOPE = _system(T.ArrayType(SYSTEM_INTERFACE, True))

POLL_ENVELOPE = struct_from(
    {
        **{name: "string" for name in POLL_FIELDS},
        "elements": T.ArrayType(struct_from({name: "string" for name in ELEMENT_FIELDS}), True),
    }
)
