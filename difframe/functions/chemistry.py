"""Formulas, element symbols and scattering factors as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Element symbols by atomic number from 1.
ELEMENTS = (
    "H He Li Be B C N O F Ne Na Mg Al Si P S Cl Ar K Ca Sc Ti V Cr Mn Fe Co Ni Cu Zn Ga Ge As Se Br Kr Rb Sr Y Zr Nb Mo Tc Ru Rh Pd Ag Cd In Sn Sb Te I Xe "
    "Cs Ba La Ce Pr Nd Pm Sm Eu Gd Tb Dy Ho Er Tm Yb Lu Hf Ta W Re Os Ir Pt Au Hg Tl Pb Bi Po At Rn Fr Ra Ac Th Pa U "
    "Np Pu Am Cm Bk Cf Es Fm Md No"
).split()
# Standard atomic weights of the elements 1 to 92.
WEIGHTS = (
    1.008, 4.0026, 6.94, 9.0122, 10.81, 12.011, 14.007, 15.999, 18.998, 20.180, 22.990, 24.305, 26.982, 28.085, 30.974, 32.06, 35.45, 39.95,
    39.098, 40.078, 44.956, 47.867, 50.942, 51.996, 54.938, 55.845, 58.933, 58.693, 63.546, 65.38, 69.723, 72.630, 74.922, 78.971, 79.904, 83.798,
    85.468, 87.62, 88.906, 91.224, 92.906, 95.95, 98.0, 101.07, 102.91, 106.42, 107.87, 112.41, 114.82, 118.71, 121.76, 127.60, 126.90, 131.29,
    132.91, 137.33, 138.91, 140.12, 140.91, 144.24, 145.0, 150.36, 151.96, 157.25, 158.93, 162.50, 164.93, 167.26, 168.93, 173.05, 174.97,
    178.49, 180.95, 183.84, 186.21, 190.23, 192.22, 195.08, 196.97, 200.59, 204.38, 207.2, 208.98, 209.0, 210.0, 222.0,
    223.0, 226.0, 227.0, 232.04, 231.04, 238.03,
)
# Cromer-Mann coefficients a1 a2 a3 a4 b1 b2 b3 b4 c by element, in the order of atomic numbers
# (International Tables for X-ray Crystallography, vol. IV, 1974, table 2.2B).
_COEFFICIENTS = """
H 0.489918 0.262003 0.196767 0.049879 20.6593 7.74039 49.5519 2.20159 0.001305
He 0.8734 0.6309 0.3112 0.178 9.1037 3.3568 22.9276 0.9821 0.0064
Li 1.1282 0.7508 0.6175 0.4653 3.9546 1.0524 85.3905 168.261 0.0377
Be 1.5919 1.1278 0.5391 0.7029 43.6427 1.8623 103.483 0.542 0.0385
B 2.0545 1.3326 1.0979 0.7068 23.2185 1.021 60.3498 0.1403 -0.1932
C 2.31 1.02 1.5886 0.865 20.8439 10.2075 0.5687 51.6512 0.2156
N 12.2126 3.1322 2.0125 1.1663 0.0057 9.8933 28.9975 0.5826 -11.529
O 3.0485 2.2868 1.5463 0.867 13.2771 5.7011 0.3239 32.9089 0.2508
F 3.5392 2.6412 1.517 1.0243 10.2825 4.2944 0.2615 26.1476 0.2776
Ne 3.9553 3.1125 1.4546 1.1251 8.4042 3.4262 0.2306 21.7184 0.3515
Na 4.7626 3.1736 1.2674 1.1128 3.285 8.8422 0.3136 129.424 0.676
Mg 5.4204 2.1735 1.2269 2.3073 2.8275 79.2611 0.3808 7.1937 0.8584
Al 6.4202 1.9002 1.5936 1.9646 3.0387 0.7426 31.5472 85.0886 1.1151
Si 6.2915 3.0353 1.9891 1.541 2.4386 32.3337 0.6785 81.6937 1.1407
P 6.4345 4.1791 1.78 1.4908 1.9067 27.157 0.526 68.1645 1.1149
S 6.9053 5.2034 1.4379 1.5863 1.4679 22.2151 0.2536 56.172 0.8669
Cl 11.4604 7.1964 6.2556 1.6455 0.0104 1.1662 18.5194 47.7784 -9.5574
Ar 7.4845 6.7723 0.6539 1.6442 0.9072 14.8407 43.8983 33.3929 1.4445
K 8.2186 7.4398 1.0519 0.8659 12.7949 0.7748 213.187 41.6841 1.4228
Ca 8.6266 7.3873 1.5899 1.0211 10.4421 0.6599 85.7484 178.437 1.3751
Sc 9.189 7.3679 1.6409 1.468 9.0213 0.5729 136.108 51.3531 1.3329
Ti 9.7595 7.3558 1.6991 1.9021 7.8508 0.5 35.6338 116.105 1.2807
V 10.2971 7.3511 2.0703 2.0571 6.8657 0.4385 26.8938 102.478 1.2199
Cr 10.6406 7.3537 3.324 1.4922 6.1038 0.392 20.2626 98.7399 1.1832
Mn 11.2819 7.3573 3.0193 2.2441 5.3409 0.3432 17.8674 83.7543 1.0896
Fe 11.7695 7.3573 3.5222 2.3045 4.7611 0.3072 15.3535 76.8805 1.0369
Co 12.2841 7.3409 4.0034 2.3488 4.2791 0.2784 13.5359 71.1692 1.0118
Ni 12.8376 7.292 4.4438 2.38 3.8785 0.2565 12.1763 66.3421 1.0341
Cu 13.338 7.1676 5.6158 1.6735 3.5828 0.247 11.3966 64.8126 1.191
Zn 14.0743 7.0318 5.1652 2.41 3.2655 0.2333 10.3163 58.7097 1.3041
Ga 15.2354 6.7006 4.3591 2.9623 3.0669 0.2412 10.7805 61.4135 1.7189
Ge 16.0816 6.3747 3.7068 3.683 2.8509 0.2516 11.4468 54.7625 2.1313
As 16.6723 6.0701 3.4313 4.2779 2.6345 0.2647 12.9479 47.7972 2.531
Se 17.0006 5.8196 3.9731 4.3543 2.4098 0.2726 15.2372 43.8163 2.8409
Br 17.1789 5.2358 5.6377 3.9851 2.1723 16.5796 0.2609 41.4328 2.9557
Kr 17.3555 6.7286 5.5493 3.5375 1.9384 16.5623 0.2261 39.3972 2.825
Rb 17.1784 9.6435 5.1399 1.5292 1.7888 17.3151 0.2748 164.934 3.4873
Sr 17.5663 9.8184 5.422 2.6694 1.5564 14.0988 0.1664 132.376 2.5064
Y 17.776 10.2946 5.72629 3.26588 1.4029 12.8006 0.125599 104.354 1.91213
Zr 17.8765 10.948 5.41732 3.65721 1.27618 11.916 0.117622 87.6627 2.06929
Nb 17.6142 12.0144 4.04183 3.53346 1.18865 11.766 0.204785 69.7957 3.75591
Mo 3.7025 17.2356 12.8876 3.7429 0.2772 1.0958 11.004 61.6584 4.387
Tc 19.1301 11.0948 4.64901 2.71263 0.864132 8.14487 21.5707 86.8472 5.40428
Ru 19.2674 12.9182 4.86337 1.56756 0.80852 8.43467 24.7997 94.2928 5.37874
Rh 19.2957 14.3501 4.73425 1.28918 0.751536 8.21758 25.8749 98.6062 5.328
Pd 19.3319 15.5017 5.29537 0.605844 0.698655 7.98929 25.2052 76.8986 5.26593
Ag 19.2808 16.6885 4.8045 1.0463 0.6446 7.4726 24.6605 99.8156 5.179
Cd 19.2214 17.6444 4.461 1.6029 0.5946 6.9089 24.7008 87.4825 5.0694
In 19.1624 18.5596 4.2948 2.0396 0.5476 6.3776 25.8499 92.8029 4.9391
Sn 19.1889 19.1005 4.4585 2.4663 5.8303 0.5031 26.8909 83.9571 4.782
Sb 19.6418 19.0455 5.0371 2.6827 5.3034 0.4607 27.9074 75.2825 4.5909
Te 19.9644 19.0138 6.14487 2.5239 4.81742 0.420885 28.5284 70.8403 4.352
I 20.1472 18.9949 7.5138 2.2735 4.347 0.3814 27.766 66.8776 4.0712
Xe 20.2933 19.0298 8.9767 1.9902 3.9282 0.344 26.4659 64.2658 3.7118
Cs 20.3892 19.1062 10.662 1.4953 3.569 0.3107 24.3879 213.904 3.3352
Ba 20.3361 19.297 10.888 2.6959 3.216 0.2756 20.2073 167.202 2.7731
La 20.578 19.599 11.3727 3.28719 2.94817 0.244475 18.7726 133.124 2.14678
Ce 21.1671 19.7695 11.8513 3.33049 2.81219 0.226836 17.6083 127.113 1.86264
Pr 22.044 19.6697 12.3856 2.82428 2.77393 0.222087 16.7669 143.644 2.0583
Nd 22.6845 19.6847 12.774 2.85137 2.66248 0.210628 15.885 137.903 1.98486
Pm 23.3405 19.6095 13.1235 2.87516 2.5627 0.202088 15.1009 132.721 2.02876
Sm 24.0042 19.4258 13.4396 2.89604 2.47274 0.196451 14.3996 128.007 2.20963
Eu 24.6274 19.0886 13.7603 2.9227 2.3879 0.1942 13.7546 123.174 2.5745
Gd 25.0709 19.0798 13.8518 3.54545 2.25341 0.181951 12.9331 101.398 2.4196
Tb 25.8976 18.2185 14.3167 2.95354 2.24256 0.196143 12.6648 115.362 3.58324
Dy 26.507 17.6383 14.5596 2.96577 2.1802 0.202172 12.1899 111.874 4.29728
Ho 26.9049 17.294 14.5583 3.63837 2.07051 0.19794 11.4407 92.6566 4.56796
Er 27.6563 16.4285 14.9779 2.98233 2.07356 0.223545 11.3604 105.703 5.92046
Tm 28.1819 15.8851 15.1542 2.98706 2.02859 0.238849 10.9975 102.961 6.75621
Yb 28.6641 15.4345 15.3087 2.98963 1.9889 0.257119 10.6647 100.417 7.56672
Lu 28.9476 15.2208 15.1 3.71601 1.90182 9.98519 0.261033 84.3298 7.97628
Hf 29.144 15.1726 14.7586 4.30013 1.83262 9.5999 0.275116 72.029 8.58154
Ta 29.2024 15.2293 14.5135 4.76492 1.77333 9.37046 0.295977 63.3644 9.24354
W 29.0818 15.43 14.4327 5.11982 1.72029 9.2259 0.321703 57.056 9.8875
Re 28.7621 15.7189 14.5564 5.44174 1.67191 9.09227 0.3505 52.0861 10.472
Os 28.1894 16.155 14.9305 5.67589 1.62903 8.97948 0.382661 48.1647 11.0005
Ir 27.3049 16.7296 15.6115 5.83377 1.59279 8.86553 0.417916 45.0011 11.4722
Pt 27.0059 17.7639 15.7131 5.7837 1.51293 8.81174 0.424593 38.6103 11.6883
Au 16.8819 18.5913 25.5582 5.86 0.4611 8.6216 1.4826 36.3956 12.0658
Hg 20.6809 19.0417 21.6575 5.9676 0.545 8.4484 1.5729 38.3246 12.6089
Tl 27.5446 19.1584 15.538 5.52593 0.65515 8.70751 1.96347 45.8149 13.1746
Pb 31.0617 13.0637 18.442 5.9696 0.6902 2.3576 8.618 47.2579 13.4118
Bi 33.3689 12.951 16.5877 6.4692 0.704 2.9238 8.7937 48.0093 13.5782
Th 35.5645 23.4219 12.7473 4.80703 0.563359 3.46204 17.8309 99.1722 13.4314
U 36.0228 23.4128 14.9491 4.188 0.1023 3.3192 16.0927 100.613 13.3966
"""
CROMER_MANN = {e: tuple(map(float, v)) for e, *v in (line.split() for line in _COEFFICIENTS.strip().splitlines())}


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def element_symbol(type_symbol) -> Column:
    """Element of an atom type (Fe3+, C.ar); empty where there is none."""
    c = F.col(type_symbol) if isinstance(type_symbol, str) else type_symbol
    return F.regexp_extract(F.coalesce(F.trim(c), F.lit("")), r"^([A-Z][a-z]?)", 1)


def formula_tokens(formula) -> Column:
    """array<struct<element, count>> of a formula; a missing count is 1."""
    c = F.col(formula) if isinstance(formula, str) else formula
    tokens = F.regexp_extract_all(c, F.lit(r"[A-Z][a-z]?\d*\.?\d*"), F.lit(0))
    count = lambda t: F.coalesce(F.regexp_extract(t, r"(\d*\.?\d*)$", 1).try_cast("double"), F.lit(1.0))
    return F.transform(tokens, lambda t: F.struct(F.regexp_extract(t, r"^([A-Z][a-z]?)", 1).alias("element"), count(t).alias("count")))


def molar_mass(formula) -> Column:
    """Molar mass of a formula; null for a null or empty one, or one with an unknown element (never a part of it)."""
    weights = _map(dict(zip(ELEMENTS, WEIGHTS, strict=False)))
    tokens = formula_tokens(formula)
    return F.when(F.size(tokens) > 0, F.aggregate(tokens, F.lit(0.0), lambda s, t: s + t["count"] * weights[t["element"]]))


def scattering_factor(element, s, table: dict[str, tuple] | None = None) -> Column:
    """Atomic scattering factor at ``s`` = sin(theta)/lambda.

    ``table`` maps elements to Cromer-Mann coefficients (a1..a4, b1..b4, c) and extends the built-in ones; elements in
    neither fall off as Z exp(-3 s^2), a blank symbol counts 1.
    """
    return scattering_at(scattering_law(element, table), s)


def scattering_law(element, table: dict[str, tuple] | None = None) -> Column:
    """struct(blank, c, z) of an element: what ``scattering_at`` needs, looked up once and not for every line."""
    e = F.col(element) if isinstance(element, str) else element
    known = F.create_map(*[x for k, v in {**CROMER_MANN, **(table or {})}.items() for x in (F.lit(k), F.array(*[F.lit(float(y)) for y in v]))])
    z = _map({x: i + 1 for i, x in enumerate(ELEMENTS)})
    return F.struct((e == "").alias("blank"), known[e].alias("c"), F.coalesce(z[e], F.lit(1)).cast("double").alias("z"))


def scattering_at(law, s) -> Column:
    """Atomic scattering factor at ``s`` by a ``scattering_law``."""
    s2 = (F.col(s) if isinstance(s, str) else s) * (F.col(s) if isinstance(s, str) else s)
    c = law["c"]
    exact = c[8]
    for i in range(4):
        exact = exact + c[i] * F.exp(-c[i + 4] * s2)
    return F.when(law["blank"], 1.0).when(c.isNotNull(), exact).otherwise(law["z"] * F.exp(-3.0 * s2))


def density(z, mass, volume) -> Column:
    """g/cm3 from formula units per cell, molar mass (g/mol) and cell volume (cubic angstrom)."""
    c = lambda x: F.col(x) if isinstance(x, str) else x
    return F.try_divide(c(z).cast("double") * c(mass), c(volume) * 0.602214076)
