"""Schemas of the tables that files are read into."""

PM_VALUES = (
    "ems string, managed_element string, object_dn string, meas_group string, counter string, value double, suspect boolean, "
    "period_start timestamp, period_end timestamp, dictionary_release string, file_name string"
)
COUNTERS_CSV = "ts timestamp, base_station string, sector string, load double, volume double, users double"
_VALUE = "struct<_measObjLdn:string,measResults:string,r:array<struct<_p:int,_VALUE:string>>,suspect:boolean>"
_TYPE = "struct<_p:int,_VALUE:string>"
PM_XML = (
    "fileHeader struct<_dnPrefix:string,_vendorName:string,fileSender:struct<_localDn:string,_elementType:string>,measCollec:struct<_beginTime:string>>, "
    f"measData array<struct<managedElement:struct<_localDn:string,_swVersion:string>,measInfo:array<struct<_measInfoId:string,granPeriod:struct<_duration:string,_endTime:string>,repPeriod:struct<_duration:string>,measTypes:string,measType:array<{_TYPE}>,measValue:array<{_VALUE}>>>>>, _corrupt_record string"
)
OMES_XML = "_startTime string, _interval int, PMMOResult array<struct<MO:array<struct<DN:array<string>>>,PMTarget:map<string,string>>>"
