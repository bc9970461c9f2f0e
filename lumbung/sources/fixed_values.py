"""Names, codes and places that results depend on."""

# Indonesian month names, January first.
MONTH_NAMES = (
    "Januari", "Februari", "Maret", "April", "Mei", "Juni",
    "Juli", "Agustus", "September", "Oktober", "November", "Desember",
)

# The two commodities (id, name).
COMMODITIES = ((1, "Sapi"), (2, "Ayam"))

# Annual indicators, their columns and the words that their labels hold.
INDICATORS = {
    "jumlah_penduduk": ("jumlah", "penduduk"),
    "populasi_sapi": ("populasi", "sapi", "potong"),
    "populasi_ayam": ("populasi", "ayam", "pedaging"),
    "produksi_daging_ayam": ("produksi", "daging", "ayam", "pedaging"),
}

# Words that mark a meat row in a price sheet.
MEAT_WORDS = (
    "daging sapi", "daging ayam", "daging kambing", "daging babi",
    "daging kerbau", "ayam ras", "ayam kampung", "sapi",
)

# Default upstream and downstream regions of the lag analysis.
DEFAULT_UPSTREAM = ("JAWA TIMUR", "NUSA TENGGARA BARAT", "NUSA TENGGARA TIMUR")
DEFAULT_DOWNSTREAM = ("DKI JAKARTA", "JAWA BARAT", "BANTEN")

# Region spellings (upper case) and the canonical name of each.
REGION_ALIASES = {
    # price series and annual statistics
    "ACEH": "Aceh",
    "SUMATERA UTARA": "Sumatera Utara",
    "SUMUT": "Sumatera Utara",
    "SUMATERA BARAT": "Sumatera Barat",
    "SUMBAR": "Sumatera Barat",
    "RIAU": "Riau",
    "KEPULAUAN RIAU": "Kepulauan Riau",
    "KEPRI": "Kepulauan Riau",
    "JAMBI": "Jambi",
    "SUMATERA SELATAN": "Sumatera Selatan",
    "SUMSEL": "Sumatera Selatan",
    "BANGKA BELITUNG": "Bangka Belitung",
    "KEPULAUAN BANGKA BELITUNG": "Bangka Belitung",
    "BABEL": "Bangka Belitung",
    "BENGKULU": "Bengkulu",
    "LAMPUNG": "Lampung",
    "JAKARTA": "DKI Jakarta",
    "DKI JAKARTA": "DKI Jakarta",
    "JAWA BARAT": "Jawa Barat",
    "JABAR": "Jawa Barat",
    "JAWA TENGAH": "Jawa Tengah",
    "JATENG": "Jawa Tengah",
    "DI YOGYAKARTA": "DI Yogyakarta",
    "YOGYAKARTA": "DI Yogyakarta",
    "DIY": "DI Yogyakarta",
    "JAWA TIMUR": "Jawa Timur",
    "JATIM": "Jawa Timur",
    "BANTEN": "Banten",
    "BALI": "Bali",
    "NTB": "Nusa Tenggara Barat",
    "NUSA TENGGARA BARAT": "Nusa Tenggara Barat",
    "NTT": "Nusa Tenggara Timur",
    "NUSA TENGGARA TIMUR": "Nusa Tenggara Timur",
    "KALIMANTAN BARAT": "Kalimantan Barat",
    "KALBAR": "Kalimantan Barat",
    "KALIMANTAN TENGAH": "Kalimantan Tengah",
    "KALTENG": "Kalimantan Tengah",
    "KALIMANTAN SELATAN": "Kalimantan Selatan",
    "KALSEL": "Kalimantan Selatan",
    "KALIMANTAN TIMUR": "Kalimantan Timur",
    "KALTIM": "Kalimantan Timur",
    "KALIMANTAN UTARA": "Kalimantan Utara",
    "KALTARA": "Kalimantan Utara",
    "SULAWESI UTARA": "Sulawesi Utara",
    "SULUT": "Sulawesi Utara",
    "SULAWESI TENGAH": "Sulawesi Tengah",
    "SULTENG": "Sulawesi Tengah",
    "SULAWESI SELATAN": "Sulawesi Selatan",
    "SULSEL": "Sulawesi Selatan",
    "SULAWESI TENGGARA": "Sulawesi Tenggara",
    "SULTRA": "Sulawesi Tenggara",
    "GORONTALO": "Gorontalo",
    "SULAWESI BARAT": "Sulawesi Barat",
    "SULBAR": "Sulawesi Barat",
    "MALUKU": "Maluku",
    "MALUKU UTARA": "Maluku Utara",
    "PAPUA": "Papua",
    "PAPUA BARAT": "Papua Barat",
    "PAPUA SELATAN": "Papua Selatan",
    "PAPUA TENGAH": "Papua Tengah",
    "PAPUA PEGUNUNGAN": "Papua Pegunungan",
    "PAPUA BARAT DAYA": "Papua Barat Daya",
    # boundary maps
    "NANGGROE ACEH DARUSSALAM": "Aceh",
    "NORTH SUMATRA": "Sumatera Utara",
    "WEST SUMATRA": "Sumatera Barat",
    "RIAU ISLANDS": "Kepulauan Riau",
    "SOUTH SUMATRA": "Sumatera Selatan",
    "KEP. BANGKA BELITUNG": "Bangka Belitung",
    "BANGKA-BELITUNG": "Bangka Belitung",
    "JAKARTA RAYA": "DKI Jakarta",
    "WEST JAVA": "Jawa Barat",
    "CENTRAL JAVA": "Jawa Tengah",
    "DAERAH ISTIMEWA YOGYAKARTA": "DI Yogyakarta",
    "EAST JAVA": "Jawa Timur",
    "WEST NUSA TENGGARA": "Nusa Tenggara Barat",
    "EAST NUSA TENGGARA": "Nusa Tenggara Timur",
    "WEST KALIMANTAN": "Kalimantan Barat",
    "CENTRAL KALIMANTAN": "Kalimantan Tengah",
    "SOUTH KALIMANTAN": "Kalimantan Selatan",
    "EAST KALIMANTAN": "Kalimantan Timur",
    "NORTH KALIMANTAN": "Kalimantan Utara",
    "NORTH SULAWESI": "Sulawesi Utara",
    "CENTRAL SULAWESI": "Sulawesi Tengah",
    "SOUTH SULAWESI": "Sulawesi Selatan",
    "SOUTHEAST SULAWESI": "Sulawesi Tenggara",
    "WEST SULAWESI": "Sulawesi Barat",
    "NORTH MALUKU": "Maluku Utara",
    "WEST PAPUA": "Papua Barat",
}

# Official two-digit region codes.
REGION_CODES = {
    "Aceh": "11", "Sumatera Utara": "12", "Sumatera Barat": "13", "Riau": "14", "Jambi": "15",
    "Sumatera Selatan": "16", "Bengkulu": "17", "Lampung": "18", "Bangka Belitung": "19",
    "Kepulauan Riau": "21", "DKI Jakarta": "31", "Jawa Barat": "32", "Jawa Tengah": "33",
    "DI Yogyakarta": "34", "Jawa Timur": "35", "Banten": "36", "Bali": "51",
    "Nusa Tenggara Barat": "52", "Nusa Tenggara Timur": "53", "Kalimantan Barat": "61",
    "Kalimantan Tengah": "62", "Kalimantan Selatan": "63", "Kalimantan Timur": "64",
    "Kalimantan Utara": "65", "Sulawesi Utara": "71", "Sulawesi Tengah": "72",
    "Sulawesi Selatan": "73", "Sulawesi Tenggara": "74", "Gorontalo": "75", "Sulawesi Barat": "76",
    "Maluku": "81", "Maluku Utara": "82", "Papua Barat": "91", "Papua": "94",
    "Papua Selatan": "95", "Papua Tengah": "96", "Papua Pegunungan": "97", "Papua Barat Daya": "98",
}

# Centre of each region (name, latitude, longitude).
REGION_CENTRES = (
    ("ACEH", 4.69, 96.75), ("SUMATERA UTARA", 2.11, 99.07), ("SUMATERA BARAT", -0.74, 100.37),
    ("RIAU", 0.29, 101.70), ("KEPULAUAN RIAU", 3.94, 108.14), ("JAMBI", -1.61, 103.61),
    ("SUMATERA SELATAN", -3.31, 104.03), ("BANGKA BELITUNG", -2.74, 107.61),
    ("BENGKULU", -3.79, 102.34), ("LAMPUNG", -4.56, 105.41), ("DKI JAKARTA", -6.21, 106.85),
    ("JAWA BARAT", -6.92, 107.60), ("JAWA TENGAH", -7.15, 110.14), ("DI YOGYAKARTA", -7.79, 110.37),
    ("JAWA TIMUR", -7.54, 112.24), ("BANTEN", -6.40, 106.11), ("BALI", -8.34, 115.09),
    ("NUSA TENGGARA BARAT", -8.65, 116.42), ("NUSA TENGGARA TIMUR", -8.66, 121.08),
    ("KALIMANTAN BARAT", 0.00, 110.42), ("KALIMANTAN TENGAH", -1.68, 113.92),
    ("KALIMANTAN SELATAN", -3.09, 115.28), ("KALIMANTAN TIMUR", 1.00, 116.87),
    ("KALIMANTAN UTARA", 3.07, 117.55), ("SULAWESI UTARA", 0.62, 124.84),
    ("SULAWESI TENGAH", -1.43, 121.44), ("SULAWESI SELATAN", -3.67, 119.92),
    ("SULAWESI TENGGARA", -4.15, 122.17), ("GORONTALO", 0.56, 122.43),
    ("SULAWESI BARAT", -2.84, 119.37), ("MALUKU", -3.24, 130.14), ("MALUKU UTARA", 1.57, 127.81),
    ("PAPUA", -4.27, 138.38), ("PAPUA BARAT", -1.34, 134.05),
)

# Columns of the star and their types, in order; old names of some of them; columns of the dimensions.
FACT_TYPES = {
    "prov_key": "int", "waktu_key": "int", "komoditas_key": "int", "jumlah_penduduk": "bigint",
    "sum_jumlah_sakit": "double", "sum_jumlah_mati": "double", "sum_vol_mutasi": "double",
    "sum_realisasi_karkas": "double", "avg_harga": "double", "harga_baseline": "double",
    "populasi_ternak": "double", "avg_konsumsi_bulanan": "double", "avg_pemotongan_bulanan": "double",
    "growth_populasi": "double", "avg_permintaan_bulanan": "double", "avg_produksi_bulanan": "double",
    "supply_risk_index": "double",
}
RENAMES = {
    "avg_produksi": "avg_produksi_bulanan", "avg_konsumsi": "avg_konsumsi_bulanan",
    "avg_pemotongan": "avg_pemotongan_bulanan", "avg_permintaan": "avg_permintaan_bulanan",
}
DIMENSION_COLUMNS = {
    "dim_prov": ["prov_key", "id_prov", "nama_provinsi"],
    "dim_komoditas": ["komoditas_key", "id_komoditas", "nama_komoditas"],
    "dim_waktu": ["waktu_key", "tahun", "bulan", "kuartal", "nama_bulan"],
}
# What the cube adds to the columns of the fact, in order.
ATTRIBUTE_TYPES = {
    "id_prov": "int", "nama_provinsi": "string", "tahun": "int", "bulan": "int", "kuartal": "int", "nama_bulan": "string",
    "id_komoditas": "int", "nama_komoditas": "string",
}

# Columns of the merged statistics and where they come from.
STATISTICS_COLUMNS = {
    "jumlah_penduduk": "jumlah_penduduk",
    "populasi_sapi": "populasi_sapi",
    "populasi_ayam": "populasi_ayam",
    "produksi_daging_ayam": "produksi_daging_ayam",
    "populasi_sapi_dummy": "populasi_sapi_dummy",
    "populasi_ayam_dummy": "populasi_ayam_dummy",
    "produksi_daging_sapi": "produksi_daging_sapi_dummy",
    "produksi_daging_ayam_dummy": "produksi_daging_ayam_dummy",
    "konsumsi_daging_sapi": "konsumsi_daging_sapi_dummy",
    "konsumsi_daging_ayam": "konsumsi_daging_ayam_dummy",
    "permintaan_daging_sapi": "permintaan_daging_sapi_dummy",
    "permintaan_daging_ayam": "permintaan_daging_ayam_dummy",
    "jumlah_ternak_sapi_potong": "jumlah_ternak_sapi_potong_dummy",
    "jumlah_ternak_ayam_potong": "jumlah_ternak_ayam_potong_dummy",
    "harga_baseline_sapi": "harga_baseline_sapi_dummy",
    "harga_baseline_ayam": "harga_baseline_ayam_dummy",
    "growth_populasi": "growth_populasi_dummy",
}
