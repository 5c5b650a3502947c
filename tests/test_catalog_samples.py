"""One own sample line per pattern family of the bundled catalog, with the fields it must yield."""

import pytest

from logweave.operators.extract import grok_extract

SAMPLES = [
    ("%{SYSLOGLINE}",
     "Mar  7 04:02:16 web-1 sshd[4242]: Accepted publickey for deploy from 10.0.0.9 port 53211",
     {"logsource": "web-1", "program": "sshd", "pid": "4242"}),
    ("%{HTTPD24_ERRORLOG}",
     "[Tue Mar 07 04:02:16.123456 2017] [core:error] [pid 1234:tid 5678] [client 10.1.2.3:4455] AH00037: Symbolic link not allowed",
     {"module": "core", "loglevel": "error", "pid": "1234", "client": "10.1.2.3", "errorcode": "AH00037"}),
    ("%{TOMCATLOG}",
     "2014-01-09 20:03:28,269 -0800 | ERROR | com.example.service.Worker - queue is full",
     {"level": "ERROR", "class": "com.example.service.Worker", "logmessage": "queue is full"}),
    ("%{CATALINALOG}",
     "Jan 9, 2014 7:13:13 AM org.apache.catalina.startup.Catalina start",
     {"class": "org.apache.catalina.startup.Catalina", "logmessage": "start"}),
    ("%{MONGO3_LOG}",
     "2017-03-07T04:02:16.123+0000 I NETWORK  [conn42] end connection 10.0.0.5:51234",
     {"severity": "I", "component": "NETWORK", "context": "conn42", "message": "end connection 10.0.0.5:51234"}),
    ("%{REDISLOG}",
     "[4018] 14 Nov 07:01:22.119 * Background saving terminated with success",
     {"pid": "4018", "timestamp": "14 Nov 07:01:22.119"}),
    ("%{RUBY_LOGGER}",
     "I, [2017-03-07T04:02:16.123456 #2345]  INFO -- app: started worker",
     {"pid": "2345", "loglevel": "INFO", "progname": "app", "message": "started worker"}),
    ("%{S3_ACCESS_LOG}",
     'owner1 bucket-a [07/Mar/2017:04:02:16 +0000] 10.0.0.1 requester1 REQ123 REST.GET.OBJECT key/a.txt '
     '"GET /key/a.txt HTTP/1.1" 200 - 512 1024 12 10 "-" "curl/7.1" -',
     {"owner": "owner1", "bucket": "bucket-a", "clientip": "10.0.0.1", "operation": "REST.GET.OBJECT",
      "verb": "GET", "response": 200, "bytes": 512, "object_size": 1024, "request_time_ms": 12, "agent": "curl/7.1"}),
    ("%{RT_FLOW3}",
     "RT_FLOW_SESSION_DENY: session denied 10.0.0.1/1234->10.0.0.2/80 junos-http 6(0) deny-all trust untrust UNKNOWN",
     {"event": "RT_FLOW_SESSION_DENY", "src-ip": "10.0.0.1", "src-port": "1234", "dst-ip": "10.0.0.2",
      "dst-port": "80", "service": "junos-http", "protocol-id": "6", "policy-name": "deny-all"}),
    ("%{NAGIOSLOGLINE}",
     "[1427925600] CURRENT SERVICE STATE: host-a;disk;OK;HARD;1;DISK OK - free space",
     {"nagios_epoch": "1427925600", "nagios_type": "CURRENT SERVICE STATE", "nagios_hostname": "host-a",
      "nagios_service": "disk", "nagios_state": "OK"}),
    ("%{JAVASTACKTRACEPART}",
     "at org.example.Main.run(Main.java:42)",
     {"class": "org.example.Main", "method": "run", "file": "Main.java", "line": "42"}),
    ("%{POSTGRESQL}",
     "2017-03-07 04:02:16 UTC app_user 5.6.7.8(5432) 1234",
     {"user_id": "app_user", "pid": "1234"}),
    ("%{BRO_DNS}",
     "1427925600.123\tCk3Hb\t10.0.0.1\t5353\t10.0.0.2\t53\tudp\t4242\texample.com\t1\tC_INTERNET\t1\tA\t0\tNOERROR\tF\tF\tT\tT\t0\t93.184.216.34\t300.0\tF",
     {"uid": "Ck3Hb", "orig_h": "10.0.0.1", "query": "example.com", "qtype_name": "A", "rcode_name": "NOERROR"}),
    ("%{CISCOFW106023}",
     'Deny tcp src outside:10.1.1.1/1234 dst inside:10.2.2.2/80 by access-group "OUTSIDE_IN" [0x0, 0x0]',
     {"action": "Deny", "protocol": "tcp", "src_interface": "outside", "src_ip": "10.1.1.1",
      "dst_ip": "10.2.2.2", "dst_port": "80", "policy_id": "OUTSIDE_IN"}),
]


@pytest.mark.parametrize("expr,line,expected", SAMPLES, ids=[s[0] for s in SAMPLES])
def test_catalog_sample(spark, expr, line, expected):
    df = spark.createDataFrame([("f", 1, line)], "file string, line_num bigint, line string")
    row = grok_extract(df, expr).first().asDict()
    assert row["_matched"], expr
    got = {k: row[k] for k in expected}
    assert got == expected
