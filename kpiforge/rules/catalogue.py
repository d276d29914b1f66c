"""The concrete KPI rules: patterns and scores as data. Order and values are fixed; rules of a KPI score together."""

from __future__ import annotations

from ..operators.rules import AnywhereRule as A
from ..operators.rules import DescriptionRule as D
from ..operators.rules import KpiRule
from ..schemas import CAN_INCLUDE, MAY_INCLUDE, MUST_EXCLUDE, MUST_INCLUDE, MUST_INCLUDE_EACH, WEIGHTED, WEIGHTED_UP_ONLY

#: Pattern, score, mode, decay from node to node, decay from hit to hit, half-life of letters, letters that are free.
KPI_2 = KpiRule(
    2.0,
    "Proven or probable reserves (Total hydrocarbons)",
    (
        D(".*prov.*develop.*undevelop.*reserv.*", 12000, CAN_INCLUDE, 0.8, 0, 20, 34),
        D(".*prov.*reserv.*", 12000, MAY_INCLUDE, 0.8, 0, 15, 15),
        D(".*total.*hydrocarbon.*", 15000, MAY_INCLUDE, 0.8, 0, 15, 17),
        D(".*(total|combine).*", 2500, CAN_INCLUDE, 0.8, 0.9, 10, 5),
        D(".*total.*(prov|prob).*reserv", 5000, MAY_INCLUDE, 0.8, 0, 15, 21),
        D(".*total.*reserv", 4000, MAY_INCLUDE, 0.8, 0, 15, 14),
        D(r'.*2p[\s]*reserv.*', 4000, MAY_INCLUDE, 0.8, 0, 10, 11),
        D(".*prov.*probab.*", 3000, MAY_INCLUDE, 0.8, 0, 10, 18),
        D("(.*(prov.*prob|prob.*prov).*|^((?!pro(b|v)).)*$)", 1, MUST_INCLUDE_EACH, 0, 0, 10, 0, counts=False, joined=True),
    ),
    units=(".*(boe|barrel.*oil|(b|m)illion.*barrel).*",),
    anywhere=(
        A(".*exploration.*", 2000, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 11),
        A(".*upstream.*", 2000, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 8),
        A("^balance sheet.*", 2000, MUST_EXCLUDE, WEIGHTED, 0.9, 0.5, 5, 0),
        A(".*((^|[^a-z])prov|(^|[^a-z])2p($|[^a-z])).*", 500, MUST_INCLUDE, WEIGHTED, 0.9, 0.2, 8, 4),
        A(".*((^|[^a-z])prob|(^|[^a-z])2p($|[^a-z])).*", 500, MUST_INCLUDE, WEIGHTED, 0.9, 0.2, 8, 4),
        A(".*((^|[^a-z])pro(b|v).*(^|[^a-z])pro(b|v)|(^|[^a-z])2p($|[^a-z])).*", 2500, MAY_INCLUDE, WEIGHTED, 0.9, 0.2, 10, 9),
    ),
)
KPI_2_1 = KpiRule(
    2.1,
    "Proven reserves (Total hydrocarbons)",
    (
        D(".*(^|[^a-z])prov.*develop.*undevelop.*reserv.*", 12000, CAN_INCLUDE, 0.8, 0, 20, 34),
        D(".*(^|[^a-z])prov.*reserv.*", 12000, MAY_INCLUDE, 0.8, 0, 15, 15),
        D(".*(^|[^a-z])prov.*reserv.*oil.*", 12000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(".*(^|[^a-z])prov.*reserv.*(oil.*gas|gas.*oil).*", 15000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(".*total.*hydrocarbon.*", 1500, MAY_INCLUDE, 0.8, 0, 15, 17),
        D(".*(total|combine).*", 1500, CAN_INCLUDE, 0.8, 0.9, 10, 5),
        D(".*total.*prov.*reserv", 5000, MAY_INCLUDE, 0.8, 0, 15, 21),
        D(".*total.*reserv", 4000, MAY_INCLUDE, 0.8, 0, 15, 14),
        D(r'.*1p[\s]*(reserv|.*p90).*', 4000, MAY_INCLUDE, 0.8, 0, 10, 11),
        D(".*(^|[^a-z])prov.*", 3000, MAY_INCLUDE, 0.8, 0, 10, 18),
        D(".*(^|[^a-z])sec.*", 1000, CAN_INCLUDE, 0.8, 0, 15, 19),
        D("^((?!prob).)*$", 1, MUST_INCLUDE_EACH, 0, 0, 10, 0, counts=False, joined=True),
        D(".*prms.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False, joined=True),
        D(".*change.*(pro|reserv).*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
    ),
    units=(".*(boe|barrel.*oil|(b|m)illion.*barrel).*",),
    anywhere=(
        A(".*exploration.*", 2000, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 11),
        A(".*upstream.*", 2000, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 8),
        A("^balance sheet.*", 2000, MUST_EXCLUDE, WEIGHTED, 0.9, 0.5, 5, 0),
        A(".*((^|[^a-z])prov|(^|[^a-z])1p($|[^a-z])).*", 500, MUST_INCLUDE, WEIGHTED, 0.9, 0.2, 8, 4),
    ),
)
KPI_3 = KpiRule(
    3.0,
    "Production",
    (
        D(".*total.*production.*", 5000, MAY_INCLUDE, 0.8, 0, 20, 16),
        D(".*hydrocarbon.*production.*", 5000, MAY_INCLUDE, 0.8, 0, 20, 22),
        D(".*oil.*production.*", 3000, MAY_INCLUDE, 0.8, 0, 20, 14),
        D(".*interest.*production.*", 3000, MAY_INCLUDE, 0.8, 0, 20, 19),
        D(".*group.*", 3000, MAY_INCLUDE, 0.8, 0, 20, 16),
        D(".*apr.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*may.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*crease.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*change.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*(total|combine).*", 1500, CAN_INCLUDE, 0.8, 0.9, 10, 5),
    ),
    units=(".*(boe|barrel.*oil|(b|m)illion.*barrel|tonnes).*",),
    anywhere=(
        A(".*production.*", 100, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 10),
    ),
)
KPI_3_1 = KpiRule(
    3.1,
    "Oil Production",
    (
        D(".*production.*", 5000, MAY_INCLUDE, 0.8, 0, 20, 10),
        D(".*oil.*", 5000, MAY_INCLUDE, 0.8, 1, 20, 14),
        D(".*(total|combine).*", 1500, CAN_INCLUDE, 0.8, 0.9, 10, 5),
    ),
    units=(".*(boe|barrel.*oil|(b|m)illion.*barrel|tonnes).*",),
    anywhere=(
        A(".*production.*", 100, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 10),
    ),
)
KPI_3_2 = KpiRule(
    3.2,
    "Liquid Hydrocarbons Production",
    (
        D(".*liquid.*hydrocarbon.*", 5000, MAY_INCLUDE, 0.8, 0, 20, 18),
        D(".*(total|combine).*", 1500, CAN_INCLUDE, 0.8, 0.9, 10, 5),
    ),
    units=(".*(boe|barrel.*oil|(b|m)illion.*barrel|ton|mt).*",),
    anywhere=(
        A(".*production.*", 100, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 10),
    ),
)
KPI_3_3 = KpiRule(
    3.3,
    "Gas Production",
    (
        D(".*production.*of.*gas.*", 5000, MAY_INCLUDE, 0.8, 0, 20, 14),
        D(".*gas.*", 3000, MAY_INCLUDE, 0.8, 1, 20, 3),
        D(".*production.*", 3000, MAY_INCLUDE, 0.8, 0, 20, 10),
        D(".*gas.*production.*", 5000, MAY_INCLUDE, 0.8, 0, 20, 14),
        D(".*(total|combine).*", 1500, CAN_INCLUDE, 0.8, 0.9, 10, 5),
        D(".*for.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*emission.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
    ),
    units=(".*(boe|barrel.*oil|(b|m)illion.*barrel|ton|mt|million|cm).*",),
    anywhere=(
        A(".*production.*", 100, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 10),
    ),
)
KPI_6 = KpiRule(
    6.0,
    "Scope 1 / Direct total GHGs emissions",
    (
        D(".*(^|[^a-z])(greenhouse)?.*(gas|ghg|(ghg)|atmospheric|co2).*emissions?.*", 7000, MAY_INCLUDE, 0.1, 0, 20, 13),
        D(".*(^|[^a-z])co2.*emissions?.*tco2e.*", 10000, MAY_INCLUDE, 0.1, 0, 20, 13),
        D(".*scope[^a-zA-Z0-9]?1.*", 12000, MAY_INCLUDE, 0.1, 0, 20, 7),
        D(".*(^|[^a-z])(greenhouse)?.*(gas|ghg|(ghg)|atmospheric|co2|combustion.*fuels?).*emissions?.*", 7000, MAY_INCLUDE, 0.1, 0, 20, 13),
        D(".*(^|[^a-z])combustion.*fuels?.*", 6000, CAN_INCLUDE, 0.1, 0, 20, 13),
        D(".*(^|[^a-z])(greenhouse)?.*(gas|ghg|(ghg)|atmospheric).*(direct)(emissions?)?.*", 9000, MAY_INCLUDE, 0.8, 0, 15, 10),
        D(".*(^|[^a-z])(greenhouse)?.*(gas|ghg|(ghg)|atmospheric).*direct.*scope[^a-zA-Z0-9]?1(emissions?)?.*", 12000, MAY_INCLUDE, 0.8, 0, 30, 14),
        D(".*(^|[^a-z])(greenhouse)?.*direct.*(gas|ghg|(ghg)|atmospheric).*scope[^a-zA-Z0-9]?1(emissions?)?.*", 12000, MAY_INCLUDE, 0.8, 0, 30, 14),
        D(r'.*scope\s1.*', 6000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(".*(^|[^a-z])(greenhouse)?.*(gas|ghg|(ghg)|atmospheric).*direct.*scope[^a-zA-Z0-9]?1(emissions?)?.*m.*t", 12000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(".*scope[^a-zA-Z0-9]?2.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(r'.*(^|[^a-z])(((gas|ghg|(ghg)|atmospheric)|direct).*emissions?|scope[^a-zA-Z0-9]?1).*(million\s? tonnes|co2[^a-zA-Z0-9]?eq)', 12000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(r'.*(^|[^a-z])((gas|ghg|(ghg)|atmospheric)|direct).*(million\s? tonnes|co2[^a-zA-Z0-9]?eq).*', 12000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(r'.*(^|[^a-z])direct.*(gas|ghg|(ghg)).*(million\s? tonnes|co2[^a-zA-Z0-9]?(eq|equivalent)).*', 12000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(".*(scope[^a-zA-Z0-9]?2|scope[^a-zA-Z0-9]?3).*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*scope[^a-zA-Z0-9]?1,?[^a-zA-Z0-9]?2.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*scope[^a-zA-Z0-9]?1.*relative.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*(^|[^a-z])(greenhouse)?.*^(?=.*(gas|ghg|(ghg)|atmospheric))(?=.*direct)(?=.*scope[^a-zA-Z0-9]?1).*$(emissions?)?.*", 12000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(".*(^|[^a-z])(greenhouse)?.*^(?=.*(gas|ghg|(ghg)|atmospheric))(?=.*direct)(?=.*operated).*$(emissions?)?.*", 6000, CAN_INCLUDE, 0.8, 0, 30, 30),
        D(".*(^|[^a-z])(greenhouse)?.*^(?=.*(gas|ghg|(ghg)|atmospheric))(?=.*direct).*$(emissions?)?.*", 12000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(".*(^|[^a-z])(greenhouse)?.*^(?=.*(gas|ghg|(ghg)|atmospheric))(?=.*scope[^a-zA-Z0-9]?1).*$(emissions?)?.*", 12000, MAY_INCLUDE, 0.8, 0, 30, 30),
        D(".*(^|[^a-z])direct.*emissions?.*", 12000, MAY_INCLUDE, 0.8, 0, 30, 16),
        D(".*(total|combine).*", 800, CAN_INCLUDE, 0.8, 1, 10, 27),
        D(".*direct no.*emissions.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*gross global scope 1 emissions.*metric.*ton.*", 20000, MAY_INCLUDE, 0.1, 0, 20, 41),
    ),
    units=(".*(ton|mn|million|kt|m t|co 2|co.*emission).*",),
    values=(".*[0-9].*[0-9].*",),
    anywhere=(
        A(".*(direct|ghg|gas).*", 500, CAN_INCLUDE, WEIGHTED, 0.9, 0.2, 8, 6),
        A(".*scope[^a-zA-Z0-9]?1.*", 500, CAN_INCLUDE, WEIGHTED, 0.7, 0.2, 8, 6),
        A(r'.*c6\.1.*', 5000, CAN_INCLUDE, WEIGHTED, 0.9, 0.2, 8, 4),
    ),
)
KPI_7 = KpiRule(
    7.0,
    "Scope 2 Energy indirect total GHGs emissions",
    (
        D(".*s.*cope( |-)2.*market", 5000, MAY_INCLUDE, 0.8, 0, 20, 15),
        D(".*s.*cope( |-)2.*", 8000, MAY_INCLUDE, 0.8, 0, 20, 28),
        D(".*indirect.*ghg.*", 3000, MAY_INCLUDE, 0.8, 1, 20, 28),
        D(".*ghg.*", 3000, CAN_INCLUDE, 0.8, 1, 20, 28),
        D(".*indirect.*", 3000, CAN_INCLUDE, 0.8, 1, 20, 28),
        D(".*co 2.*", 3000, MAY_INCLUDE, 0.8, 0, 20, 3),
        D(".*market.*", 3000, CAN_INCLUDE, 0.8, 1, 20, 29),
        D(".*electricity.*", 500, CAN_INCLUDE, 0.8, 1, 20, 27),
        D(".*indirect.*emissions.*", 3000, MAY_INCLUDE, 0.8, 1, 20, 28),
        D(".*(total|combine).*", 1500, CAN_INCLUDE, 0.8, 1, 10, 27),
        D(".*sale.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*s.*cope( |-)3.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*(upstream|refin).*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
    ),
    units=("^(t|.*(ton|mn|million|kt|m t|co 2).*)$",),
    anywhere=(
        A(".*(environment|emission).*", 100, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 10),
        A(".*total.*", 100, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 10),
        A(".*tons.*co.*", 100, MAY_INCLUDE, WEIGHTED, 0.05, 0.01, 5, 8),
        A(".*million metric.*", 200, MAY_INCLUDE, WEIGHTED, 0.05, 0.01, 5, 14),
    ),
)
KPI_8 = KpiRule(
    8.0,
    "Scope 3 Upstream Energy indirect total GHGs emissions",
    (
        D(".*s.*cope( |-)3.*", 8000, MUST_INCLUDE, 0.8, 0, 20, 28),
        D(".*ghg.*", 3000, CAN_INCLUDE, 0.8, 0, 20, 28),
        D(".*indirect.*", 3000, MAY_INCLUDE, 0.8, 0, 20, 28),
        D(".*emissions.*", 3000, CAN_INCLUDE, 1, 1, 20, 28),
        D(".*(total|combine).*", 1500, CAN_INCLUDE, 0.8, 0, 20, 28),
        D(".*intensity.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*s.*cope( |-)2.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
        D(".*305.*", 1, MUST_EXCLUDE, 0, 0, 10, 0, counts=False),
    ),
    units=(".*(ton|mn|million|kt|m t|co 2).*",),
    anywhere=(
        A(".*(environment|emission).*", 100, MAY_INCLUDE, WEIGHTED, 0.9, 0.5, 5, 11),
    ),
)
KPI_12 = KpiRule(
    12.0,
    "Target Year Reduction",
    (
        D(".*targeted reduction from base year.*", 8000, MUST_INCLUDE, 0.1, 0, 20, 33),
    ),
    values=(r'[0-9]{2,3}(\.[0-9]+)?',),
    anywhere=(
        A(".*target year.*", 5000, MUST_INCLUDE, WEIGHTED, 0.9, 0.2, 8, 4),
        A(".*scope 1.*", 5000, CAN_INCLUDE, WEIGHTED, 0.9, 0.2, 8, 4),
        A(r'.*c4\.1a.*', 5000, CAN_INCLUDE, WEIGHTED, 0.9, 0.2, 8, 4),
    ),
)
KPI_9991 = KpiRule(
    9991.0,
    "C0.4 Currency of CDP Report",
    (
        D(r'.*\(c0\.4\) select the currency used.*', 8000, CAN_INCLUDE, 0.1, 0, 20, 87),
        D(r'.*\(c0\.4\).*', 2000, MUST_INCLUDE, 0.1, 0, 20, 87),
    ),
    values=("[A-Z]{3,3}",),
    numeric=False,
)
KPI_9992 = KpiRule(
    9992.0,
    "C4.1 Currency of CDP Report",
    (
        D(r'.*\(c4\.1\) *did you have an emissions target.*', 8000, CAN_INCLUDE, 0.1, 0, 20, 78),
        D(r'.*\(c4\.1\).*', 2000, MUST_INCLUDE, 0.1, 0, 20, 78),
    ),
    values=("[A-Z ]{3,35}target[A-Z ]{0,10}",),
    numeric=False,
)
KPI_9993 = KpiRule(
    9993.0,
    "C4.2b Year target set",
    (
        D(".*year target was set.*", 8000, MUST_INCLUDE, 0.1, 0, 20, 19),
    ),
    values=("(19[8-9]|20[0-2])[0-9]",),
    anywhere=(
        A(r'.*\(c4\.2b\) *provide details of .*targets.*', 5000, MUST_INCLUDE, WEIGHTED_UP_ONLY, 0.9, 0.2, 8, 79),
    ),
    year=True,
)
KPI_9994 = KpiRule(
    9994.0,
    "C4.2b Base year",
    (
        D(".*base year.*", 8000, MUST_INCLUDE, 0.1, 0, 20, 19),
    ),
    values=("(19[8-9]|20[0-2])[0-9]",),
    anywhere=(
        A(r'.*\(c4\.2b\) *provide details of .*targets.*', 5000, MUST_INCLUDE, WEIGHTED_UP_ONLY, 0.9, 0.2, 8, 79),
    ),
    year=True,
)

#: The rules that apply unless a list is given; those of disclosure questionnaires are kept apart.
ACTIVE = (KPI_2, KPI_2_1, KPI_3, KPI_3_1, KPI_3_2, KPI_3_3, KPI_6, KPI_7, KPI_8, KPI_12)
QUESTIONNAIRE = (KPI_9991, KPI_9992, KPI_9993, KPI_9994)
