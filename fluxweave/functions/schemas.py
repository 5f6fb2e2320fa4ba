"""Explicit schemas of the tables."""

from __future__ import annotations

EXCHANGE = "struct<internalId:int,isInput:boolean,isQuantitativeReference:boolean,isAvoidedProduct:boolean,amount:double,unit:struct<name:string>,flowProperty:struct<`@id`:string>,flow:struct<`@id`:string,name:string,flowType:string>,defaultProvider:struct<`@id`:string,name:string>>"
FACTOR = "struct<allocationType:string,product:struct<`@id`:string>,exchange:struct<internalId:int>,value:double>"
PROCESS = f"`@id` string, name string, version string, lastChange string, location struct<name:string>, defaultAllocationMethod string, exchanges array<{EXCHANGE}>, allocationFactors array<{FACTOR}>"
FLOW = "`@id` string, name string, flowType string, flowProperties array<struct<flowProperty:struct<`@id`:string,name:string,refUnit:string>,conversionFactor:double,isRefFlowProperty:boolean>>"
FOREGROUND = "process_name string, exchange_type string, flow_uuid string, provider_uuid string, flow_name string, amount string, unit string, is_ref string, location string, comment string"
RESULT = "scenario string, method string, score double, unit string, functional_unit string"
REQUIRED = {
    "elementary_flow": ("Flow UUID", "Flowable", "Unit", "Context", "Class", "CAS No"),
    "cf": ("Indicator", "Indicator unit", "Flow UUID", "Flowable", "Location", "Characterization Factor"),
    "foreground": ("process_name", "exchange_type", "flow_uuid", "provider_uuid", "flow_name", "amount", "unit", "is_ref"),
    "result": ("scenario", "method", "score", "unit", "functional_unit"),
    "library_flow": ("row", "flow_id", "flow_type"),
    "library_process": ("process_id",),
    "library_inventory": ("row", "process_id", "value"),
    "contribution": ("scenario", "method", "process_name", "contribution_score"),
}
