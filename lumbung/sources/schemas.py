"""Staging tables: file names and columns."""

_DUMMY = (
    "jumlah_penduduk", "populasi_sapi", "populasi_ayam", "produksi_daging_sapi", "produksi_daging_ayam", "konsumsi_daging_sapi",
    "konsumsi_daging_ayam", "permintaan_daging_sapi", "permintaan_daging_ayam", "jumlah_ternak_sapi_potong",
    "jumlah_ternak_ayam_potong", "harga_baseline_sapi", "harga_baseline_ayam", "growth_populasi",
)

# name in the plans: (table in the staging area, columns)
STAGING = {
    "bps_api_raw": (
        "staging_bps_api_raw",
        "provinsi string, tahun int, jumlah_penduduk string, populasi_sapi string, populasi_ayam string, produksi_daging_ayam string",
    ),
    "bps_dummy_raw": (
        "staging_bps_dummy_raw", "provinsi string, tahun int, " + ", ".join(f"{c}_dummy double" for c in _DUMMY),
    ),
    "ref_hewan": ("staging_isikhnas_ref_hewan", "id_hewan string, nama_hewan string, kategori string"),
    "ref_wilayah": ("staging_isikhnas_ref_wilayah", "id_wilayah int, provinsi string"),
    "tr_mutasi": (
        "staging_isikhnas_tr_mutasi",
        "id_mutasi string, tgl_mutasi string, id_asal int, id_tujuan int, id_hewan string, jumlah_ekor double",
    ),
    "tr_laporan_sakit": (
        "staging_isikhnas_tr_laporan_sakit",
        "id_laporan string, tgl_lapor string, id_wilayah int, id_hewan string, jumlah_gejala double, jumlah_mati double",
    ),
    "tr_hasil_lab": (
        "staging_isikhnas_tr_hasil_lab", "id_uji string, id_laporan string, tgl_uji string, penyakit string, hasil_uji string",
    ),
    "tr_rph": (
        "staging_isikhnas_tr_rph", "id_potong string, tgl_potong string, id_wilayah int, id_hewan string, berat_karkas double",
    ),
    "pihps_raw": ("staging_pihps_raw", "provinsi string, nama_komoditas string, harga double, waktu timestamp_ntz"),
}
EVENT_TABLES = ("ref_hewan", "ref_wilayah", "tr_mutasi", "tr_laporan_sakit", "tr_hasil_lab", "tr_rph")
