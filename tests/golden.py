"""The published season table (labels, the eight sums, the three derived columns)
and the figures of the published model."""

from trapiche.config import DEFAULT_SPEC

COLUMNS = DEFAULT_SPEC.season_schema.fieldNames()

SEASONS = [
    ("2015-2016", 54188608.817, 52085148.886, 778929.565, 6117048.109, 1894292.565, 3849056.3279999997, 228631.1, 145068.116, 11.744322978491487, 66.86759782445799, 0.0),
    ("2016-2017", 53308643.193, 51156048.4141, 777078.382, 5957170.457, 1621570.828, 3814390.016, 258823.7, 262385.913, 11.64509504091806, 65.83125923853072, -2.613640585313892),
    ("2017-2018", 53335716.5941, 51218399.6161, 784660.66935, 6009520.177, 1461694.9, 3522595.469, 209928.5, 1918.65, 11.73312759095067, 65.27458507449911, 0.8787682067832314),
    ("2018-2019", 55192520.556, 35810635.8319, 765810.491, 6209957.8165, 1411437.85, 3692249.6705, 177625.15, 174476.09100000001, 17.341099012177242, 46.761746218882756, 3.3353351614847204),
    ("2019-2020", 48063334.942, 39058938.7081, 764690.719, 5130823.6542, 1220726.464, 3019122.2162, 184337.4, 3303.65, 13.136106161368833, 51.078086522585345, -17.37747975409295),
    ("2020-2021", 51292545.271, 49144353.85, 789995.998924, 5715447.6211, 1348266.764, 3410438.4271, 182721.15, 35875.5, 11.629917118342577, 62.20835791185803, 11.39434925660401),
    ("2021-2022", 54680830.706, 52319939.86, 799773.648123, 6185049.9586000005, 1361790.8423000001, 3747032.7183, 134390.55, 1583.65, 11.821592255553485, 65.41843430674466, 8.21637024134989),
    ("2022-2023", 47563829.744, 45498865.2515, 806192.881, 5224247.76485, 1193051.4207000001, 3228622.67915, 70752.45, 1613.75, 11.482149578835415, 56.43669936041025, -15.534267308771755),
    ("2023-2024", 46093813.734, 44026929.144999996, 743062.443764, 4703547.3886, 1099466.036, 3244818.5646, 61393.5, 3240.175, 10.683341945356114, 59.25064510323058, -9.966992372632044),
    ("2024-2025", 45750073.6639, 43524750.856, 736485.911492, 4770525.3506000005, 934785.9094, 3309080.2402, 64502.85, 4906.5, 10.960488588167005, 59.09787298962172, 1.4239882468779719),
    ("2025-2026", 6122603.623, 5723383.4520000005, 72848.532, 562916.187201, 77383.606, 445009.377201, 6880.5, 7495.5, 9.835374336211784, 78.56552898004863, -88.2001216673086),
]

SUMS_SCHEMA = "zafra string, " + ", ".join(f"{c} double" for c in COLUMNS[1:9])
SUMS = [row[:9] for row in SEASONS]

# Published model and next-season forecast.
B0, B1 = 18791.171858116766, 0.09951992220305844
NEXT_CANE, NEXT_SUGAR, MEAN_RATIO = 5181641.763939138, 534467.7570894583, 0.9053459037640481
