"""Standard names of federal agencies and organizations.

Fixed values: a table of names, in rule order. The first matching agency row counts, then its
first matching organization row. ``has`` means the text contains the words, ``equal`` that it
equals them; the first field of a row is the standard name.
"""

from __future__ import annotations

from siteledger.operators.rename import AgencyRule, OrgRule

_INSPECTOR = OrgRule("Office Of Inspector General", has=("General",))
_CIO = "Office of the Chief Information Officer"


def _always(name: str) -> AgencyRule:
    """An agency whose organizations all get one name, that of the agency itself."""
    return AgencyRule(name, (OrgRule(name),))


OWNER_RULES = (
    AgencyRule(
        "Corporation for National",
        (_INSPECTOR,),
        contains=True,
        agency_to="Corporation for National and Community Service",
    ),
    AgencyRule(
        "U.S. Department of Agriculture",
        (
            OrgRule("Forest Service", has=("Forest Service",), lacks="Sensing"),
            OrgRule("Department of Agriculture", equal=("USDA",)),
            OrgRule(_CIO, has=("OCIO",)),
            OrgRule("National Agricultural Library", has=("NAL",)),
        ),
        agency_to="Department of Agriculture",
    ),
    AgencyRule(
        "Department of State",
        (
            _INSPECTOR,
            OrgRule("ASEAN Connect", has=("ASEAN",)),
            OrgRule("Department of State", has=("of State",)),
        ),
        contains=True,
        agency_to="Department of State",
    ),
    AgencyRule(
        "Federal Housing Finance Agency",
        (_INSPECTOR,),
        contains=True,
        agency_to="Federal Housing Finance Agency",
    ),
    AgencyRule(
        "United States Postal Service",
        (_INSPECTOR,),
        contains=True,
        agency_to="United States Postal Service",
    ),
    _always("Department of Education"),
    _always("Broadcasting Board of Governors"),
    AgencyRule(
        "Department of Justice",
        (
            OrgRule(
                "Bureau of Alcohol, Tobacco, Firearms and Explosives", has=("Alcohol", "ATF")
            ),
            OrgRule("Drug Enforcement Agency", has=("DEA",)),
            OrgRule("Federal Bureau of Investigation", has=("Bureu",), equal=("FBI",)),
            OrgRule(
                "Domestic Security Alliance Council",
                equal=(
                    "U.S. Department of Justice, BI, Domestic Security Alliance Council (DSAC)",
                ),
            ),
            OrgRule("Office of Justice Programs", has=("Office of Justice Programs", "OJP")),
            OrgRule("Criminal Justice Information Services", has=("CJIS",)),
            OrgRule("Institute for Intergovernemental Research", has=("Intergovernemental",)),
            OrgRule("Regional Computer Forensics Laboratory", has=("RCFL",)),
            OrgRule("Criminal Division", has=("Criminal Division",)),
            OrgRule("Office of e-Government", has=("Office of e-Government",)),
            OrgRule("Department of Justice", has=("Department of Justice",)),
        ),
    ),
    AgencyRule(
        "Department of Veterans Affairs",
        (
            OrgRule(
                "Department of Veterans Affairs", equal=("U.S. Department of Veterans Affairs",)
            ),
        ),
    ),
    AgencyRule(
        "National Archives and Records Administration",
        (
            OrgRule(
                "National Archives and Records Administration",
                equal=("NARA", "U.S. National Archives and Records Administration"),
            ),
        ),
    ),
    AgencyRule("Environmental Protection Agency"),
    AgencyRule(
        "Department of Commerce",
        (
            OrgRule("National Institute of Standards & Technology", has=("Standards",)),
            OrgRule("Minority Business Development Agency", has=("MBDA",)),
            OrgRule(
                "NASA Goddard Space Flight Center",
                has=("NASA",),
                agency_to="National Aeronautics and Space Administration",
            ),
            OrgRule("Patent and Trademark Office", has=("USPTO",)),
            OrgRule(equal=("ECONOMIC DEVELOPMENT ADMINISTRATION",), title=True),
            OrgRule("NOAA National Climatic Data Center", has=("NCDC",)),
            OrgRule("Department of Commerce", has=("Department of Commerce",)),
        ),
    ),
    AgencyRule(
        "Department of Labor",
        (
            OrgRule(_CIO, has=("OCIO",)),
            OrgRule("Employment and Training Administration", has=("ETA",)),
        ),
    ),
    AgencyRule(
        "General Services Administration",
        (
            OrgRule("Technology Transformation Service", has=("TTS",)),
            OrgRule("18F", has=("18F",)),
            OrgRule("Office of Citizen Services Innovative Technologies", has=("OSCIT",)),
            OrgRule(
                "Office of Federal High-Performance Green Buildings", has=("High-Performance",)
            ),
            OrgRule(has=("STEERING",), title=True),
            OrgRule("Office of Administrative Services", has=("OAS",)),
            OrgRule("Federal Acquisition Institute", has=("FAI",)),
            OrgRule("Office of Government-wide Policy", has=("OGP",)),
            OrgRule("Federal Acquisition Service", has=("FAS",)),
            OrgRule("Integrated Acquisition Environment", has=("IAE",)),
            OrgRule(
                "General Services Administration",
                has=("General Services Administration",),
                equal=("GSA",),
            ),
        ),
    ),
    _always("Consumer Product Safety Commission"),
    _always("Federal Deposit Insurance Corporation"),
    AgencyRule(
        "United States AbilityOne",
        (OrgRule("Committee for Purchase From People Who are Blind or Severely Disabled"),),
    ),
    AgencyRule(
        "Department of Housing and Urban Development",
        (
            OrgRule("Office of Policy Development and Research", has=("Policy Development",)),
            OrgRule("Department of Housing and Urban Development", has=("Urban Development",)),
        ),
    ),
    _always("Council of Inspectors General on Integrity and Efficiency"),
    AgencyRule(
        "Department of Health and Human Services",
        (
            OrgRule("Agency for Healthcare Research and Quality", equal=("AHRQ",)),
            OrgRule("National Heart, Lung & Blood Institute", has=("Heart",)),
            OrgRule(
                "Substance Abuse and Mental Health Services Administration", has=("SAMHSA",)
            ),
            OrgRule("National Institute on Alcohol Abuse and Alcoholism", has=("NIAAA",)),
            OrgRule("National Library of Medicine", has=("LIbrary",)),
            OrgRule("National Cancer Institute", has=("NCI",)),
            OrgRule(
                "Department of Health and Human Services",
                has=("DHHS", "Department of Health"),
                equal=("Dept of Health and Human Services", "HHS"),
            ),
        ),
    ),
    AgencyRule(
        "Office of Personnel Management",
        (
            OrgRule(
                "Office of Personnel Management", equal=("U.S. Office of Personnel Management",)
            ),
        ),
    ),
    AgencyRule(
        "Department of the Treasury",
        (
            OrgRule(
                "Citizens Coinage Advisory Committee", has=("Citizens Coinage Advisory Committee",)
            ),
            OrgRule("Mint", has=("Mint",)),
            OrgRule("Bureau of Engraving and Printing", has=("BEP",)),
            OrgRule("Comptroller of the Currency", has=("OCC",)),
            OrgRule(
                "Office of Citizen Services",
                equal=("General Services Administration, Office of Citizen Services",),
                agency_to="General Services Administration",
            ),
            OrgRule("FinCEN", has=("FINCEN",)),
            OrgRule("Internal Revenue Service", has=("IRS",)),
            OrgRule("Bureau of the Fiscal Service", equal=("Department of the Treasury - FS",)),
            OrgRule("Bureau of the Public Debt", has=("BPD",)),
            OrgRule("Financial Management Service", has=("FMS",)),
            OrgRule(_CIO, has=("OCIO",)),
            OrgRule("Office of Financial Research", has=("OFR",)),
            OrgRule("Office of Thrift Supervision", has=("OTS",)),
            OrgRule("Community Development Financial Institutions Fund", has=("CDFI",)),
            OrgRule(
                "Department of the Treasury",
                has=("Department of the Treasury",),
                equal=("Treasury",),
            ),
        ),
    ),
    _always("National Credit Union Administration"),
    AgencyRule(
        "Department of Transportation",
        (
            OrgRule(_CIO, equal=("OCIO",)),
            OrgRule(
                "The Federal Aviation Administration, Telecommunications Unit", has=("AMi400",)
            ),
            OrgRule("Mike Monroney Aeronautical Center", has=("MMAC",)),
            OrgRule("National Highway Traffic Safety Administration", equal=("NHTSA",)),
            OrgRule("Department of Transportation", has=("Department of Transportation",)),
        ),
    ),
    AgencyRule(
        "Department of the Interior",
        (
            OrgRule("Office of Inspector General", has=("OIG",)),
            OrgRule("Wetland and Aquatic Reserch Center", has=("NWRC",)),
            OrgRule("Volcano Science Center", has=("Volcano Science Center",)),
            OrgRule("US Geological Survey", has=("Survey",)),
            OrgRule("Fish and Wildlife Service", has=("Fish and Wildlife",)),
            OrgRule("Department of the Interior", equal=("Department of Interior",)),
        ),
    ),
    AgencyRule(
        "Department of Homeland Security",
        (
            OrgRule(_CIO, has=(_CIO,)),
            OrgRule("US Citizenship and Immigration Services", equal=("USCIS",)),
            OrgRule("United States Computer Emergency Readiness Team", equal=("US-CERT",)),
            OrgRule("Federal Emergency Management Agency", equal=("FEMA",)),
            OrgRule(
                "Transportation Security Administration, Credentialing Program Office",
                equal=("TSA CPO",),
            ),
        ),
    ),
    _always("Nuclear Regulatory Commission"),
    AgencyRule(
        "U.S. Agency for International Development",
        (
            OrgRule("Center on Children in Adversity", equal=("USAID/GH.CECA",)),
            OrgRule(
                "U.S. Agency for International Development",
                has=("Agency for International Development",),
            ),
        ),
    ),
    AgencyRule(
        "Department of Energy",
        (
            OrgRule("Department of Energy", equal=("US DEPARTMENT OF ENERGY",)),
            OrgRule("Office of Energy Efficiency and Renewable Energy", equal=("EERE",)),
            OrgRule("Office of Scientific and Technical Information", equal=("OSTI",)),
            OrgRule("Oak Ridge Associated Universities", equal=("ORAU",)),
            OrgRule("National Nuclear Security Administration", equal=("NNSA",)),
            OrgRule(_CIO, has=("Office of the CIO",)),
        ),
    ),
    AgencyRule(
        "Department of Defense",
        (
            OrgRule("National Reconnaissance Office", equal=("NRO",)),
            OrgRule(
                "Multijurisdictional Counterdrug Task Force Training Program", equal=("MCTFT",)
            ),
            OrgRule("National Security Agency", equal=("NSA",)),
            OrgRule(equal=("OFFICE OF WARRIOR CARE POLICY",), title=True),
        ),
    ),
)
