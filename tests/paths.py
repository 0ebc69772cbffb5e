"""Places of the driver's tables; test modules import these from here."""

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
