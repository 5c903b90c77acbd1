"""Small input rows for the line parsers and the event operators, one boundary case each.

Headerless comma-separated lines: ad clicks (user, ad, province, city, epoch s),
logins (user, ip, success|fail, epoch s), order events (order, create|pay, tx or empty,
epoch s) and receipts (tx, channel, epoch s).
"""

# Key (11, 500) clicks six times on one day (once late, twice in one second) and once on the next.
AD_CLICKS = """\
11,500,north,nova,1700000001
12,500,south,sol,1700000002
11,500,north,nova,1700000002
11,500,north,nova,1700000003
12,501,south,sol,1700000030
11,500,north,nova,1700000003
11,500,north,nova,1700000010
11,501,north,nova,1700000011
11,500,north,nova,1700006400
11,500,north,nova,1700000005
"""

# 21: fails exactly two seconds apart; 22: a success between fails, in the second of the later
# fail; 23: four fails in a row; 24: no fail.
LOGINS = """\
21,10.0.0.1,fail,1700000100
21,10.0.0.1,fail,1700000102
22,10.0.0.2,fail,1700000100
22,10.0.0.2,success,1700000101
22,10.0.0.2,fail,1700000101
23,10.0.0.3,fail,1700000111
23,10.0.0.3,fail,1700000110
23,10.0.0.3,fail,1700000112
23,10.0.0.3,fail,1700000113
21,10.0.0.1,success,1700000103
24,10.0.0.4,success,1700000100
"""

# o1: paid; o2: paid exactly at 15 minutes; o3: never paid; o4 and o6: pay without create, o6
# without a transaction; o5: paid a second before 15 minutes, its lines the wrong way round.
ORDERS = """\
o1,create,,1700001000
o2,create,,1700001000
o3,create,,1700001005
o4,pay,t4,1700001010
o1,pay,t1,1700001060
o6,pay,,1700001500
o2,pay,t2,1700001900
o5,pay,t5,1700002899
o5,create,,1700002000
"""

# t1 +3 s, t2 -5 s, t5 +51 s, t4 +60 s; t9 belongs to no pay.
RECEIPTS = """\
t1,wechat,1700001063
t2,alipay,1700001895
t9,alipay,1700001000
t4,wechat,1700001070
t5,wechat,1700002950
"""
