"""Organisation names, their parents and spellings.

One row per organisation: canonical name, parent, service, state, spellings.
Order matters: when two organisations share a spelling the later one wins.
"""

ALIASES = [
    # Pennsylvania
    ("PPL Electric Utilities Corporation", "PPL Corporation", "electric", "PA",
     ["PPL Electric Utilities Corporation", "PPL Electric Utilities Corp.",
      "PPL Electric Utilities Corp", "PPL EU", "PPL Electric"]),
    ("PECO Energy Company", "Exelon Corporation", "electric", "PA",
     ["PECO Energy Company", "PECO Energy Co.", "PECO"]),
    ("Duquesne Light Company", "Duquesne Light Holdings Inc.", "electric", "PA",
     ["Duquesne Light Company", "Duquesne Light Co.", "DLC", "Duquesne Light Co"]),
    ("Philadelphia Gas Works", None, "gas", "PA",
     ["Philadelphia Gas Works", "PGW"]),
    ("Columbia Gas of Pennsylvania Inc.", "NiSource Inc.", "gas", "PA",
     ["Columbia Gas of Pennsylvania Inc.", "Columbia Gas of Pennsylvania", "Columbia Gas of PA",
      "Columbia Gas PA", "CPA"]),
    ("UGI Utilities Inc.", "UGI Corporation", "gas", "PA",
     ["UGI Utilities Inc.", "UGI Utilities", "UGI Utilities Inc. - Gas Division",
      "UGI Utilities Inc. - Electric Division", "UGI Gas", "UGI Electric"]),
    ("National Fuel Gas Distribution Corporation", "National Fuel Gas Company", "gas", "PA",
     ["National Fuel Gas Distribution Corporation", "National Fuel Gas Distribution Corp.",
      "National Fuel Gas Distribution Corp", "NFG Distribution", "National Fuel Gas"]),
    ("Aqua Pennsylvania Inc.", "Essential Utilities Inc.", "water", "PA",
     ["Aqua Pennsylvania Inc.", "Aqua Pennsylvania", "Aqua PA"]),
    ("Pennsylvania American Water Company", "American Water Works Company Inc.", "water", "PA",
     ["Pennsylvania American Water Company", "Pennsylvania American Water", "PA American Water",
      "PAWC"]),
    ("Peoples Natural Gas Company", "Essential Utilities Inc.", "gas", "PA",
     ["Peoples Natural Gas Company", "Peoples Natural Gas", "Peoples Gas", "PNG"]),
    # California
    ("Pacific Gas and Electric Company", "PG&E Corporation", "electric", "CA",
     ["Pacific Gas and Electric Company", "Pacific Gas & Electric Company",
      "Pacific Gas & Electric", "Pacific Gas and Electric", "PG&E", "PGE"]),
    ("Southern California Edison Company", "Edison International", "electric", "CA",
     ["Southern California Edison Company", "Southern California Edison", "So. Cal. Edison",
      "SoCal Edison", "SCE"]),
    ("San Diego Gas & Electric Company", "Sempra Energy", "electric", "CA",
     ["San Diego Gas & Electric Company", "San Diego Gas and Electric Company",
      "San Diego Gas & Electric", "SDG&E", "SDGE"]),
    ("Southern California Gas Company", "Sempra Energy", "gas", "CA",
     ["Southern California Gas Company", "Southern California Gas", "So. Cal. Gas", "SoCalGas",
      "SCG"]),
    ("California Water Service Company", "California Water Service Group", "water", "CA",
     ["California Water Service Company", "California Water Service", "Cal Water", "CalWater",
      "CWS"]),
    # Oregon
    ("Portland General Electric Company", "Portland General Electric Company", "electric", "OR",
     ["Portland General Electric Company", "Portland General Electric", "PGE", "PGE Oregon"]),
    ("PacifiCorp dba Pacific Power", "Berkshire Hathaway Energy", "electric", "OR",
     ["PacifiCorp", "PacifiCorp dba Pacific Power", "Pacific Power", "Pacific Power & Light",
      "PacifiCorp dba Pacific Power & Light"]),
    ("NW Natural Gas Company", "Northwest Natural Holding Company", "gas", "OR",
     ["NW Natural Gas Company", "NW Natural", "Northwest Natural Gas", "Northwest Natural"]),
    ("Avista Corporation dba Avista Utilities", "Avista Corporation", "gas", "OR",
     ["Avista Corporation dba Avista Utilities", "Avista Corporation", "Avista Utilities",
      "Avista"]),
    # Indiana
    ("Duke Energy Indiana LLC", "Duke Energy Corporation", "electric", "IN",
     ["Duke Energy Indiana LLC", "Duke Energy Indiana", "DEI"]),
    ("Indiana Michigan Power Company", "American Electric Power Company", "electric", "IN",
     ["Indiana Michigan Power Company", "Indiana Michigan Power", "I&M",
      "AEP Indiana Michigan"]),
    ("CenterPoint Energy Indiana South", "CenterPoint Energy Inc.", "gas", "IN",
     ["CenterPoint Energy Indiana South", "CenterPoint Energy Indiana", "CenterPoint Indiana",
      "Vectren South"]),
    ("Indiana American Water Company Inc.", "American Water Works Company Inc.", "water", "IN",
     ["Indiana American Water Company Inc.", "Indiana American Water Company",
      "Indiana American Water"]),
    ("Indianapolis Power & Light Company", "AES Corporation", "electric", "IN",
     ["Indianapolis Power & Light Company", "Indianapolis Power and Light Company",
      "Indianapolis Power & Light", "IPL", "AES Indiana"]),
    # Washington
    ("Puget Sound Energy", "Puget Energy Inc.", "electric", "WA",
     ["Puget Sound Energy", "PSE", "Puget Sound Energy Inc."]),
    ("Avista Corporation", "Avista Corporation", "electric", "WA",
     ["Avista Corporation", "Avista Utilities", "Avista"]),
    ("PacifiCorp dba Pacific Power & Light", "Berkshire Hathaway Energy", "electric", "WA",
     ["PacifiCorp dba Pacific Power & Light", "PacifiCorp", "Pacific Power & Light",
      "Pacific Power"]),
    ("Cascade Natural Gas Corporation", "MDU Resources Group Inc.", "gas", "WA",
     ["Cascade Natural Gas Corporation", "Cascade Natural Gas", "Cascade Gas", "CNG"]),
    # Connecticut
    ("Eversource Energy", "Eversource Energy", "electric", "CT",
     ["Eversource", "Eversource Energy Service Company"]),
    ("Connecticut Light and Power Company", "Eversource Energy", "electric", "CT",
     ["Connecticut Light and Power Company", "Connecticut Light & Power", "CL&P"]),
    ("United Illuminating Company", "Avangrid Inc.", "electric", "CT",
     ["United Illuminating Company", "The United Illuminating Company", "UI"]),
    ("Connecticut Natural Gas Corporation", "Avangrid Inc.", "gas", "CT",
     ["Connecticut Natural Gas Corporation", "Connecticut Natural Gas Corp.", "CNG"]),
    ("Southern Connecticut Gas Company", "Avangrid Inc.", "gas", "CT",
     ["Southern Connecticut Gas Company", "SCG"]),
    ("Yankee Gas Services Company", "Eversource Energy", "gas", "CT",
     ["Yankee Gas Services Company", "Yankee Gas", "YGS"]),
    ("Aquarion Water Company", "Eversource Energy", "water", "CT",
     ["Aquarion Water Company", "Aquarion Water Company of Connecticut"]),
    # Missouri
    ("Ameren Missouri", "Ameren Corporation", "electric", "MO",
     ["Union Electric Company", "AmerenUE", "Ameren Missouri (Union Electric)"]),
    ("Evergy Missouri West Inc.", "Evergy Inc.", "electric", "MO",
     ["Evergy Missouri West Inc.", "Evergy Missouri West", "KCP&L Greater Missouri Operations",
      "GMO"]),
    ("Evergy Metro Inc.", "Evergy Inc.", "electric", "MO",
     ["Evergy Metro Inc.", "Evergy Metro", "KCP&L", "Kansas City Power & Light",
      "Kansas City Power and Light"]),
    ("Empire District Electric Company", "Liberty Utilities", "electric", "MO",
     ["Empire District Electric Company", "The Empire District Electric Company",
      "Liberty-Empire"]),
    ("Spire Missouri Inc.", "Spire Inc.", "gas", "MO",
     ["Spire Missouri Inc.", "Spire Missouri", "Laclede Gas Company", "Laclede Gas",
      "Missouri Gas Energy", "Spire"]),
    ("Atmos Energy Corporation", "Atmos Energy Corporation", "gas", "MO",
     ["Atmos Energy", "Atmos Energy Corporation"]),
    # Georgia
    ("Georgia Power Company", "Southern Company", "electric", "GA",
     ["Georgia Power Company", "Georgia Power Co."]),
    ("Atlanta Gas Light Company", "Southern Company Gas", "gas", "GA",
     ["Atlanta Gas Light Company", "Atlanta Gas Light Co.", "AGL"]),
]
