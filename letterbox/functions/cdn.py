"""The nested access-log record: its declared types and column labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, types as T

from .schemas import struct_from_fields

# Declared type of each field, structs as DDL column lists.
CDN_FIELDS = {
    "cp": "string",
    "start": "string",
    "processedTime": "string",
    "type": "string",
    "id": "string",
    "geo": (
        "city : string, country : string, lat : string, region : string, area : string, "
        "zip : string, long : string"
    ),
    "reqid": "string",
    "guid": "string",
    "message": (
        "bytes : string, cliIP : string, fwdHost : string, proto : string, protoVer : string, "
        "reqHost : string, reqMethod : string, reqPath : string, reqPort : string, "
        "respCT : string, respLen : string, status : string, queryStr : string, UA : string"
    ),
    "netPerf": (
        "netOriginLatency : integer, downloadStatus : string, clientRTT : integer, "
        "midMileLatency : integer, asnum : string, downloadTime : string, edgeIP : string, "
        "lastByte : string, errCdR14 : string, errCdF29 : string"
    ),
    "cache": (
        "cacheHit : string, cacheable : string, cacheStatus : string, cacheStats : string, "
        "cacheH : string"
    ),
    "waf": (
        "riskScores : string, pRate : integer, warnActions : string, ver : string, "
        "warnSlrs : string, warnRules : string, pAction : string, riskGroups : string, "
        "warnData : string, denyActions : string, denySlrs : string, anomScr : string, "
        "warnTags : string, denyMsg : string, riskTuples : string, warnMsg : string, "
        "policy : string, denyRules : string, denyData : string"
    ),
    "network": (
        "nw : string, nwType : string, throughput : string, proxy : string, bw : string"
    ),
    "reqHdr": (
        "cookie : string, reqTime : string, accEnc : string, accLang : string, auth : string, "
        "reqCacheCtl : string, reqConn : string, reqContMD5 : string, DNT : string, "
        "expect : string, ifMatch : string, ifMod : string, ifNone : string, ifRange : string, "
        "ifUnmod : string, range : string, referer : string, te : string, upgrade : string, "
        "reqVia : string, xFrwdFor : string, xReqWith : string"
    ),
    "respHdr": (
        "accRange : string, respCacheCtl : string, respConn : string, respContMD5 : string, "
        "respVia : string, allowOrigin : string, age : string, allow : string, "
        "contEnc : string, contLang : string, contDisp : string, contRange : string, "
        "expires : string, link : string, p3p : string, retry : string, trailer : string, "
        "transEnc : string, vary : string, warning : string, wwwAuth : string, "
        "setCookie : string, date : string, eTag : string, lastMod : string, server : string, "
        "xPwrdBy : string"
    ),
}

# Label of each leaf, in the order of the field dictionary.
CDN_LABELS = {
    "Client IP": "message.cliIP",
    "Request Host": "message.reqHost",
    "Response Content Type": "message.respCT",
    "Cookie": "reqHdr.cookie",
    "Referer": "reqHdr.referer",
    "Warning": "respHdr.warning",
    "country": "geo.country",
    "region": "geo.region",
    "city": "geo.city",
    "latitude": "geo.lat",
    "longitude": "geo.long",
    "Protocol Type": "message.proto",
    "Protocol Version": "message.protoVer",
    "HTTP Status Code": "message.status",
    "Request Port": "message.reqPort",
    "Request Method": "message.reqMethod",
    "Request Path": "message.reqPath",
    "Response Content Length": "message.respLen",
    "Bytes": "message.bytes",
    "User-Agent": "message.UA",
    "Forward Hostname": "message.fwdHost",
    "Query string": "message.queryStr",
    "Request Time": "reqHdr.reqTime",
    "Accept-Encoding": "reqHdr.accEnc",
    "Accept-Language": "reqHdr.accLang",
    "Authorization": "reqHdr.auth",
    "Request Cache-Control": "reqHdr.reqCacheCtl",
    "Request Connection": "reqHdr.reqConn",
    "Request Content-MD5": "reqHdr.reqContMD5",
    "DNT": "reqHdr.DNT",
    "Expect": "reqHdr.expect",
    "If-Match": "reqHdr.ifMatch",
    "If-Modified-Since": "reqHdr.ifMod",
    "If-None-Match": "reqHdr.ifNone",
    "If-Range": "reqHdr.ifRange",
    "If-Unmodified-Since": "reqHdr.ifUnmod",
    "Range": "reqHdr.range",
    "TE": "reqHdr.te",
    "Upgrade": "reqHdr.upgrade",
    "Request Via": "reqHdr.reqVia",
    "X-Forwarded-For": "reqHdr.xFrwdFor",
    "X-Requested-With": "reqHdr.xReqWith",
    "Download Time": "netPerf.downloadTime",
    "Last Byte": "netPerf.lastByte",
    "Asnum": "netPerf.asnum",
    "Edge IP": "netPerf.edgeIP",
    "Error Code R14": "netPerf.errCdR14",
    "Error Code F29": "netPerf.errCdF29",
    "Client RTT": "netPerf.clientRTT",
    "Mid Mile Latency": "netPerf.midMileLatency",
    "Net Origin Latency": "netPerf.netOriginLatency",
    "Download Status": "netPerf.downloadStatus",
    "Accept-Ranges": "respHdr.accRange",
    "Access-Control-Allow-Origin": "respHdr.allowOrigin",
    "Age": "respHdr.age",
    "Allow": "respHdr.allow",
    "Content-Encoding": "respHdr.contEnc",
    "Content-Language": "respHdr.contLang",
    "Content-Disposition": "respHdr.contDisp",
    "Content-Range": "respHdr.contRange",
    "Date": "respHdr.date",
    "ETag": "respHdr.eTag",
    "Expires": "respHdr.expires",
    "Last-Modified": "respHdr.lastMod",
    "Link": "respHdr.link",
    "P3P": "respHdr.p3p",
    "Retry-After": "respHdr.retry",
    "Server": "respHdr.server",
    "Trailer": "respHdr.trailer",
    "Transfer-Encoding": "respHdr.transEnc",
    "Vary": "respHdr.vary",
    "WWW-Authenticate": "respHdr.wwwAuth",
    "X-Powered-By": "respHdr.xPwrdBy",
    "Set-Cookie": "respHdr.setCookie",
    "Response Cache-Control": "respHdr.respCacheCtl",
    "Response Connection": "respHdr.respConn",
    "Response Content-MD5": "respHdr.respContMD5",
    "Response Via": "respHdr.respVia",
    "area": "geo.area",
    "zip": "geo.zip",
    "Network": "network.nw",
    "Network Type": "network.nwType",
    "Throughput": "network.throughput",
    "Bandwidth": "network.bw",
    "Proxy": "network.proxy",
    "Cache hit": "cache.cacheHit",
    "Cacheable": "cache.cacheable",
    "Cache stats": "cache.cacheStats",
    "Cache hierarchy": "cache.cacheH",
    "Cache status": "cache.cacheStatus",
    "Waf version": "waf.ver",
    "Policy id": "waf.policy",
    "Risk groups": "waf.riskGroups",
    "Risk tuples": "waf.riskTuples",
    "Risk scores": "waf.riskScores",
    "p action": "waf.pAction",
    "p rate": "waf.pRate",
    "Warn rules": "waf.warnRules",
    "Warn slrs": "waf.warnSlrs",
    "Warn data": "waf.warnData",
    "Warn tags": "waf.warnTags",
    "Deny rules": "waf.denyRules",
    "Deny data": "waf.denyData",
    "Warn msg": "waf.warnMsg",
    "Deny msg": "waf.denyMsg",
    "Deny slrs": "waf.denySlrs",
    "Warn actions": "waf.warnActions",
    "Deny actions": "waf.denyActions",
    "Anom scr": "waf.anomScr",
}


def cdn_declared() -> dict:
    """The record's schema as its documents declare it."""
    return {
        "fields": [
            {"name": name, "dataType": dtype, "nullable": True, "metadata": {}}
            for name, dtype in CDN_FIELDS.items()
        ]
    }


def cdn_schema() -> T.StructType:
    return struct_from_fields(cdn_declared()["fields"])


def labelled(df: DataFrame, labels: list[str] | None = None) -> list[Column]:
    """Leaves of the record under their labels, all of them unless named."""
    chosen = CDN_LABELS if labels is None else {k: CDN_LABELS[k] for k in labels}
    columns = []
    for label, path in chosen.items():
        struct, leaf = path.split(".")
        columns.append(df[struct].getField(leaf).alias(label))
    return columns
