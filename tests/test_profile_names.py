"""Segment naming (CAT-1) against the original tool's published cluster profiles."""

import pytest
from pyspark.sql import functions as F

# FIXED VALUES: (mean salary, mean experience, education mode, top-3 industries,
# expected name) of the nine published cluster profiles.
PROFILES = [
    (17659.0, 3.2, "本科", ["互联网/电子商务", "计算机软件", "电子技术/半导体/集成电路"], "中高级技术岗"),
    (11633.0, 1.0, "本科", ["计算机软件", "互联网/电子商务", "电子技术/半导体/集成电路"], "初级入门岗"),
    (11371.0, 2.6, "大专", ["计算机软件", "互联网/电子商务", "通信/电信/网络设备"], "中级技术岗"),
    (17731.0, 3.4, "本科", ["计算机软件", "互联网/电子商务", "保险"], "中高级技术岗"),
    (21889.0, 3.2, "本科", ["计算机软件", "通信/电信/网络设备", "电子技术/半导体/集成电路"], "高薪技术岗"),
    (16008.0, 3.7, "本科", ["计算机软件", "制药/生物工程", "金融/投资/证券"], "中高级技术岗"),
    (24260.0, 2.4, "硕士", ["互联网/电子商务", "医疗设备/器械", "机械/设备/重工"], "高学历高薪岗"),
    (18940.0, 3.3, "本科", ["计算机软件", "医疗设备/器械", "互联网/电子商务"], "中高级技术岗"),
    (37431.0, 6.4, "本科", ["电子技术/半导体/集成电路", "专业服务(咨询、人力资源、财会)", "计算机软件"], "高薪资深岗"),
]


@pytest.mark.parametrize("i", range(len(PROFILES)))
def test_segment_name(spark, i):
    from hirelens.ml.profile import segment_name
    s, e, edu, inds, name = PROFILES[i]
    df = spark.createDataFrame([(s, e, edu, ", ".join(f"{x}:1" for x in inds))], "s double, e double, edu string, inds string")
    got = df.select(segment_name(F.col("s"), F.col("e"), F.col("edu"), F.col("inds"))).first()[0]
    assert got == name
