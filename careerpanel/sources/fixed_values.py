"""Price index, legal wage limits and occupation crosswalks.

They must equal the published ones for results to be right, so they are stated plainly.
"""

# Fixed values. Consumer price index, 2015 = 100: year, cpi
CPI = """
1975 40.109550561797754
1976 41.80224719101123
1977 43.347752808988766
1978 44.5252808988764
1979 46.365168539325836
1980 48.867415730337086
1981 51.95842696629214
1982 54.6814606741573
1983 56.44775280898877
1984 57.84606741573034
1985 59.02359550561798
1986 58.949999999999996
1987 59.09719101123596
1988 59.833146067415726
1989 61.525842696629205
1990 63.14494382022472
1991 65.5
1992 68.8
1993 71.9
1994 73.8
1995 75.1
1996 76.1
1997 77.6
1998 78.3
1999 78.8
2000 79.9
2001 81.5
2002 82.6
2003 83.5
2004 84.9
2005 86.2
2006 87.6
2007 89.6
2008 91.9
2009 92.2
2010 93.2
2011 95.2
2012 97.1
2013 98.5
2014 99.5
2015 100
2016 100.5
2017 102
"""

# Fixed values. Contribution assessment ceiling in EUR per day: year, west, east
ASSESSMENT_CEILING = """
1975 47.06441766411191 47.06441766411191
1976 51.967706804783646 51.967706804783646
1977 57.1522064801133 57.1522064801133
1978 62.193544428708016 62.193544428708016
1979 67.23999529611469 67.23999529611469
1980 70.40489204071928 70.40489204071928
1981 73.96348353384496 73.96348353384496
1982 79.00482148243968 79.00482148243968
1983 84.0461594310344 84.0461594310344
1984 87.17015282514329 87.17015282514329
1985 90.76964766876466 90.76964766876466
1986 94.13394824703579 94.13394824703579
1987 95.81609853617135 95.81609853617135
1988 100.5813388689201 100.5813388689201
1989 102.53958677390162 102.53958677390162
1990 105.89877443336077 105.89877443336077
1991 109.26307501163188 109.26307501163188
1992 113.99252491269691 80.46711626266087
1993 121.02790119795688 89.09261029844107
1994 127.75138943568716 99.1752861956305
1995 131.11569001395827 107.58092472249633
1996 134.11186043776812 113.99252491269691
1997 137.83917825168854 119.34575090882132
1998 141.1983659111477 117.66871353849771
1999 142.88051620028324 121.02790119795688
2000 144.16897174089775 119.0236370236677
2001 146.24481677855437 122.71005148709244
2002 147.95 123.29
2003 167.67 139.73
2004 168.85 142.62
2005 170.96 144.66
2006 172.6 144.66
2007 172.6 149.59
2008 173.77 147.54
2009 177.53 149.59
2010 180.82 152.88
2011 180.82 157.8
2012 183.61 157.38
2013 190.68 161.1
2014 195.62 164.38
2015 198.9 170.96
2016 203.28 177.05
2017 208.77 187.4
"""

# Fixed values. Marginal part-time income threshold in EUR per day: year, west, east
MARGINAL_THRESHOLD = """
1975 5.884969552568474 5.884969552568474
1976 6.493406891191975 6.493406891191975
1977 7.142747580311172 7.142747580311172
1978 6.554761916935521 6.554761916935521
1979 6.554761916935521 6.554761916935521
1980 6.539423160499634 6.539423160499634
1981 6.554761916935521 6.554761916935521
1982 6.554761916935521 6.554761916935521
1983 6.554761916935521 6.554761916935521
1984 6.539423160499634 6.539423160499634
1985 6.723488237730273 6.723488237730273
1986 6.892214558525025 6.892214558525025
1987 7.2296672001145295 7.2296672001145295
1988 7.377941845661432 7.377941845661432
1989 7.562006922892071 7.562006922892071
1990 7.8994595644815755 7.8994595644815755
1991 8.068185885276327 8.068185885276327
1992 8.380073932806022 5.03111211097079
1993 8.906704570438126 6.554761916935521
1994 9.412883532822383 7.3983935209092815
1995 9.750336174411887 7.8994595644815755
1996 9.888384982334866 8.380073932806022
1997 10.25140221798418 8.743091168455337
1998 10.420128538778933 8.743091168455337
1999 10.588854859573685 10.588854859573685
2000 10.563290265513874 10.563290265513874
2001 10.588854859573685 10.588854859573685
2002 10.68 10.68
2003 13.15 13.15
2004 13.11 13.11
2005 13.15 13.15
2006 13.15 13.15
2007 13.15 13.15
2008 13.11 13.11
2009 13.15 13.15
2010 13.15 13.15
2011 13.15 13.15
2012 13.15 13.15
2013 14.79 14.79
2014 14.79 14.79
2015 14.79 14.79
2016 14.79 14.79
2017 14.79 14.79
"""

# Fixed values. Occupation group -> two-digit occupations (KldB 1992): group, targets in their listed order
KLDB92_2 = """
1: 1 2 3 4
2: 5 6
3: 7 8 9 10 11
4: 12 13
5: 14
6: 14
7: 15
8: 16
9: 17
10: 17
11: 18
12: 19 20
13: 21
14: 22
15: 22
16: 22
17: 23 24
18: 24
19: 25 26
20: 26
21: 26
22: 27
23: 27
24: 27
25: 28
26: 28
27: 28
28: 29 30
29: 30
30: 31
31: 31
32: 31
33: 32
34: 32
35: 32
36: 33 34 37
37: 35 36
38: 39
39: 40
40: 41
41: 42 43
42: 44
43: 45
44: 45
45: 46
46: 46
47: 47
48: 48
49: 48
50: 49 50
51: 50
52: 51
53: 51
54: 52
55: 52
56: 53
57: 54
58: 54
59: 60
60: 60
61: 60
62: 60
63: 61
64: 62
65: 62
66: 62
67: 62
68: 62
69: 63
70: 63
71: 63
72: 68
73: 68
74: 68
75: 68
76: 69
77: 69
78: 70
79: 70
80: 71
81: 71
82: 72
83: 73
84: 74
85: 74
86: 74
87: 75
88: 75
89: 76
90: 77
91: 77
92: 77
93: 78
94: 78
95: 78
96: 79
97: 79
98: 80 81
99: 82
100: 83
101: 83
102: 84
103: 85
104: 85
105: 85
106: 85
107: 85
108: 86 89
109: 86
110: 86
111: 87
112: 87
113: 88
114: 90
115: 91
116: 91
117: 92
118: 93
119: 93
120: 93
"""

# Fixed values. Occupation group -> Blossfeld occupations: group, targets in their listed order
BLOSSFELD = """
1: 1 11 5
2: 1 5
3: 2
4: 2 3
5: 2
6: 3 2
7: 2
8: 2 3
9: 3
10: 3 2
11: 2
12: 2 3
13: 2
14: 3
15: 2
16: 2
17: 2
18: 2
19: 3 2
20: 3
21: 3
22: 3
23: 3
24: 3
25: 3
26: 3
27: 3
28: 3 2
29: 4 3
30: 3
31: 3 2
32: 3
33: 2
34: 2
35: 2
36: 3 2
37: 3 2
38: 3
39: 3 2
40: 3 2
41: 3 2
42: 3 2
43: 3 2
44: 2
45: 2
46: 2 3
47: 2
48: 3 2
49: 3 2
50: 3 2
51: 3
52: 3
53: 2
54: 2
55: 2
56: 2
57: 3 2
58: 2
59: 5
60: 5
61: 5
62: 5
63: 5
64: 4
65: 4
66: 4
67: 4
68: 4
69: 4
70: 4
71: 4
72: 11
73: 10
74: 11 7 6
75: 10 6
76: 11
77: 11
78: 11
79: 11 7 6
80: 7 6
81: 6
82: 4 6 5
83: 10 4
84: 6
85: 6
86: 6
87: 12
88: 12
89: 12
90: 11
91: 10
92: 11
93: 11
94: 10
95: 10
96: 6
97: 6
98: 7 6 9
99: 8
100: 7
101: 7 6
102: 9
103: 7
104: 8
105: 7
106: 7 4
107: 7
108: 8 9 7
109: 8
110: 8
111: 9 8
112: 8
113: 9 5
114: 7
115: 6
116: 6
117: 7 6
118: 6
119: 6
120: 6
"""
