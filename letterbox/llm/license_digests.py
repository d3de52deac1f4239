"""Digests of whole license texts in the canonical form of ``licenses``: fixed values, by license.

Several for one license: with and without its title, 'All rights reserved', the
appendix that tells how to apply it, numbers of its clauses, http or https. They
are made by ``licenses._digest(licenses.canonical(text))`` of the texts that the
licenses' authors publish, as SPDX lists them under the names used here.
"""

from __future__ import annotations

DIGESTS: dict[str, list[str]] = {
    "0BSD": [
        "135f996b0799264a94667b307181b4e708ac75af3dd183e62a37bd0555cbf0cc",
        "25a274d52b3014d9bd64e0f3362fd279ac1655f163d5c518f6b9f6c43354802c",
        "3d7b7ce2a6e224f3ce2c959b8b26ed63938ae9ac89a1a93812c66acfe9971516",
        "53695ed162cb0132fe0563719addeac105c8cad72350fae9183e2c74a7c0dbbe",
        "9c842909bcc85365ba7f0d106fccdc3af51784431076174588a9832837ebf153",
    ],
    "Apache-2.0": [
        "2b4a3f34572f63637f58db72bdacad38516a1e1e6788b08931d0a0d5c0be33dd",
        "6074c3536c43b739207170b87d1681477d0f07374ed3d862ba461334cce848e3",
        "6530dac82be99e5bbcc128a6caf5bfdd0451a21fe23ac3df15ed85a1c550c859",
        "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64",
        "8318fc18753641674a0b35f73f00e865e8cceb1ed8b6eb85f62d4a5d5146a5f1",
        "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe",
    ],
    "Artistic-1.0-Perl": [
        "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702",
    ],
    "BSD-2-Clause": [
        "07009138c2c60079b5c0af517b8bd8b4b42ffc843cc131a20d92d08a8f23f9fd",
        "218f5b650f149e23f159537f8b1ab16d0ff44722e0038a34bb90a58b3442864a",
        "23d7258e25bd67982ccec4b5bfc05631a20f8ee5bd5fe7eb70694c100aae88d2",
        "2d43d7fea89b3633b95184ddd4e7d55c0d384cc18515de6da01adef25b3a8439",
        "3851d34d50dcbb9256e3af58b5c99e83430619b6380f4adc9b118e7abf80bce6",
        "3938f828c79910468f483f925e6a33217162693f71035d6044cbd04dc6fd1bd5",
        "447686a56472ea2e9713ca89034ee666e6646bd1a33eba38690cb875708663e2",
        "4a5b45ed3ca9ae854c5505a774b3659d3852be9a3412b822802b3cdbe5dc7b0a",
        "5d123f3d2076a6b22f7b17a92623627ef50d1584e8cf13b7d4040f1c6e8a0424",
        "69cdbd21a2d990e706160e435568bdf1c22727c4ed2cab0cfaa1b78b3904ced3",
        "7ff364231b3920929bc5aeb795343ae30f2aea77866054735ecb69e0e70f55b6",
        "8906363799dbe7a6aff07f665d7698ad3e34b029f09df3d473bf1118a17a2f1f",
        "8b28f63734bf310903015ecd26ae5c979f31743ca170703b95426d7203774453",
        "957c3854a3d72e069e7f5e48857ad9ab76135f14c70d60fa9ec6ef9a928d45dd",
        "986c3c3199a93b916c8f2e0aeed57819bcbdcb2cd9d99902dcc9d74b53f93a74",
        "a11471bc40750a21bd4508891b5626642657a09eaa0ef1ec576be7d37fe5ada8",
        "a56fee4b2f66331ed54da4950ef9c9391453fd1490b4d8ea202bc29683bcbd30",
        "a78184b2c67ed3906485a7e9161d724c95e04261082e06a27869e1753384b18c",
        "b7d49d651647319f38c254df78d020e1c773cbac121d97b17eb70bf3149e7233",
        "b9578a124b7f83b06b28da656e009d5188b5c664c402b7c018c56cfaeb24b00a",
        "bc1e385eb5d19c6613b84fb0a516cbaef80caefb192cf62a0c520c07f0fcab07",
        "bf4cd629bb8a70e349537e8ca530dc88576938ec375a2ede8054a0ebaf7ae836",
        "c5cb44b340dfa97436d18371e401686dddf3451388afa1a24c0e410cd7a38b24",
        "cb19805eac283bd8cea786373cc0e19cabbf15bc4cbd572dc1efb3dbd05ca91d",
        "d8273d18414549823077df21707b29ce7fb0661f8dd82fdb4b3632c3d07901fe",
        "d9360b475bb35dc9bce111eec4d3be1faa67ed2a3a561f03ad44e73b4993919a",
        "e74f02edf06350e22d771b60d0580c53e28783fd12eda06abd03dab1348bc9d9",
        "e90608a663ae638023eb95a6ae359f7b6b865e6237fa832c48500c4e1af035b9",
        "eda2ad636e738f6a26a2fea902bb734ee48c789a5b40035b8db3659bd951e5bc",
        "f38fa2034bf54944a35dd1ff3703481e42a97c80896b1db58621ba8ec98c2048",
        "f4befedc01589c90d5effeae5f64453726c8fded8e4b6fe6c36f99d303581f1f",
        "f9c0de945db946a0b06e8587a80b1b35b3f3e48a0f63cb64860eb4e433d32c7b",
    ],
    "BSD-3-Clause": [
        "007fde9b266f35183b511c8c01994581175bfdaa48438967e905c31fb50ba523",
        "02cbb88221e507a296bab4438d8c41fc55a45c1e486982b72971ef667bab440e",
        "07002ede2e559c6e97a5ba89a53d7ded83eda46c54cea64eb39745675c2aabfc",
        "0fd715971b9eef40682d457e9b18f9eb0bdde1b640847b28593e4094f8871915",
        "1238550805feaeec7ac6f60c2a1b7b3828c3fb1e9d9d52c718c3b75c7b5ff98e",
        "14c74613c04ea95836287e807ac4917f2ed4c10d2e06252eb8e6db7fe57926af",
        "19a4781693c27171941c3997100df63b3707e99f2135091c98fb3aba3429a921",
        "214aa9c28152d6d77e6bebfb4a7511e677f65fdaf94b0fe9c0bb580e0eaf8997",
        "326c317935b3409d9750fd4ad5326ce15c9b75d313b4baf2cb9ff54accf8d903",
        "39bc19d2e32c4824fe446a931672e4ee8ceee7bf191f76bf6c99140b01c64550",
        "3f60f0cdf78f0a92c80fac67aa6cd8641363b5b786d18f78a1122a6db9a6b96b",
        "4e9ad430816ef99d7c5e6f810b75a4656b10387721550916a7e39572d8d9f186",
        "4fec7901c0764f1c632da504aa28d5de5e7e5f0783c88d1e3fd21de4f97e315d",
        "53075742228962c7ea381b8242c64602fa32e7b8f52facb6d13ee4f9c596ddfa",
        "5a2a789d3e539c6419b99449d506cdb442ff86f4bc70a376a2dbf45467861f83",
        "5a6e7ec0b1ac1e224277a8a6d5cd7691ea38298b0308b87a7a2e539d020ed1e0",
        "6e5ff3a5e17bf78bc2302e3f5b9d296c357ef3a5760035e625deb6e953d1e58b",
        "73a15ef51d0f74bce7fc4d1287b8d8a639c37581de7f63863957aea115dca7da",
        "7aea53c0d7a37e67b5b48bc0173358fa13cce6248e39e0f781aa1f29758b4c03",
        "7b57614be5d1abd5826bb4b7096a1d2f91fdc92e36f49112bf162ea0ced57045",
        "7c16b387b2fd67aea7403110df9457eea9844b938eda62df5f98a56797001ccf",
        "84c781b5d7e3445d472ea78f86da8ce1f7cf3f8a699eed9e76e2fde2284fa9b6",
        "91ac11f4f00a65b8efdaf9acd840fb61dee7a83cdbd51b27a0939b4188201497",
        "9b83d3dee0616d07b82a272dd9bf5134a9f402b750f5ee6188458073b0a32ff2",
        "9b9ac51f5ca1f4f99ccf94a0770c77723a9b4a5eaf09e0de3f8c9ec65b1f396d",
        "cc65957a28f15bbcef5b0c23770aae3bd8462cb25904250f77a812ab3b2efe15",
        "cf77ee3d20f4076cecdb58fc53aa7204c9f5c0651621abbc85e028f5b2ffa6b4",
        "da336ff5d6bbb6a30ad59a0dd798c7e6e1e57d719bbb6300725786c3648c658d",
        "dd9c572087f92a74232343008a70468eeee08d97112450db549eb0fb33a8d29e",
        "eabe215ff5a2cf5b1c090915b7cabdf511f70fc79fb8fde85247ebe3038a9658",
        "f94931e221f919e6cec5ca99e0ea7da1912b2c7d805cdaee8baf508c248bc1af",
        "fcfaca9856c9d06723391332be070f14157dc455699d40c8852a50b70f45fada",
    ],
    "BSL-1.0": [
        "5fcf89bde8c0c2deb999f4cc626e1aebf90e80fdc5cd334dae008152ef4a1ded",
    ],
    "CC0-1.0": [
        "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",
    ],
    "GFDL-1.2": [
        "292b028a70f5d02d8af35de86bccfece18261230f118b98e599872b0762a48a4",
        "61501da4fb94cceda16cd9affa2c77a91451ac2041c3baac644d4090c86855de",
    ],
    "GFDL-1.3": [
        "9c5ce247c584edabcc67759e6b66e362b9edb8815ce8209f9106e3a0c9a05581",
        "cdf3d9ad52a468f1e3a38b3cd70b6b38978b4acbb41cceee134bf4e2e6168fe4",
    ],
    "GPL-1.0": [
        "90b42d1cf0f9ef747c945cda0a54d5bd16341c8491956c54b3f4f283efa0176a",
        "d408d9dad6e4560274412e743ec3ba01007197655029f60544c308bc54f80499",
    ],
    "GPL-2.0": [
        "0bfb659bf7eeb9921df1446a6a93beba70e0dc947eec10a42d26bb310dccd498",
        "8607b1cff63e9a9dc468bf76327bdd0bb2d2abe09d6e8076427fd49236f46f29",
    ],
    "GPL-3.0": [
        "0472008b2e64866eb1db6471e76fc0cc3cf742180a15ea30a01655e5d9952441",
        "4daf25711475345bba3326eb65ac074ad13b96798bf4bd295a284f56837f3ac0",
        "7d478223d8fcde6480339b8bbaadacf6b93d7007d04a13fbd30f71a80fd981a0",
        "d9de3adc6f88fd297c319c8e5efae6a00c1606770b4d22bd8fdc95a7071b5251",
    ],
    "ISC": [
        "23651ce8a73abaa8fad9143faad3fca843b5de6baf345008f65c453ea5685fb1",
        "40e6eb51c3b409d93549806b55b249c261dab149d19b56cc163624f39a08b1db",
        "5456fff23cf44064ff54d9d973cf8a7204e2788759d3d01ba3de38afc4515eee",
        "71e638daa9a9b5572892642ad3b2898d7860124998d2bff139e1f88d7dd38679",
        "80c91bc2efd3e78116e00fde9052e737ea04907e8766e36081f7f7c856edfa95",
        "83381f2ba91f8b4b5a524e928f0229510a7656a35772582d1c5e0f3ac5112220",
        "86cadf6b8ff9a33f9f1268672376624474ebcae80a1a08747115581a22146101",
        "fd4e450e334b5e7722a9cb4a5ef92dda5eeb172eeee17b631a720d12591461b1",
    ],
    "LGPL-2.0": [
        "9ccbf81e2fd78db81966e466a22ed39318d0a4b4550cd69d1144dcf09722ff10",
        "9e78fa98415a9a8c863589ab742457328d22cd2319bbf585de04b27baf33a2be",
    ],
    "LGPL-2.1": [
        "a9cc8dda4023821e198a2e1bee36afc3e68fce90828780c7bac37ffe33565e15",
        "f13ce8aa4b0cc0de7c3b73a95e705f217972ef8710e7c0a463342682e2e523de",
    ],
    "LGPL-3.0": [
        "3ce770135de37fc153de7af30789ebf6cf1e9ad54eb9b487647ea8aa9ccae9c2",
        "ab1202917a49a52eb4671fc091c00933076c119053fff6e8b5849ca93d6b53b3",
    ],
    "MIT": [
        "00a5c934b705d69594539c6a37a1105192217249a30fe111a375560a492639c9",
        "6ad3654379e72bbdf8478d5c90fb1e2525aba033fbe675e0ef2248aac67c0f6f",
        "7c3366b22b9f0d6a198b2c29bd1c4b663b2d55eacbd066146e5476c4b8ff1ce4",
        "8cde46b543036122641d289a848d3900df55f9efa471b2ff7354da3a6e4a113d",
        "95d6e15f26b09973979cc939f067e143dab922c3ae8273ea44b568d429da0660",
        "9803b59d0b48bc4c33519eaf3d6e133d08c752f8f17a5cd3d6198abdf08e49c4",
        "fb691d28b64b2a306b30449f04b63780c13263eccc568cc65d7f25fe9748dba2",
    ],
    "MPL-1.1": [
        "3f0343dd4f3b064be36e0c6584737c9b7bb5c322721694563f9009e088ce96d1",
        "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b",
    ],
    "MPL-2.0": [
        "4019e4c8fe9ede57c538b37b3332dc097a88c163e273bb6905d38316e63c2eb6",
        "6fedd8db6adb0e102fc0f69b9e1501d2edaf25940e34910831cab46f9f5d4e4d",
    ],
    "Unlicense": [
        "8d3909f4543649cfba0b0b1fc765c67acf3736106a78237ea2972f83eaa7dd3e",
        "e004e218cb49cc5380ae88b74959546d5ffade35d8fa0f2d1fe2c87f91a33b89",
        "e0a799e7d185f19d7fdcb7cb051a4177ef6512052fc563b932e65ca1e5805e14",
        "e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229",
        "f507d73d343a3d7b0b7ecd39319f6c349b515eeed80b814918af61cdac69e4a5",
    ],
    "Zlib": [
        "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7",
        "650ad42ca78a7de669d6cdb6370d08407db85fb523ec1120eac8064af9d15be0",
        "6639a2a838439b2f70d60db893a595aca137c59bd50f4b6f5ec2be9ada5db66e",
        "8c81ff67b5987d3b4f6370ab81f9b187be4db6b537e08d1cb5d36a5a3ba2027f",
        "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a",
        "9ddc78a5797b5008d488969fd959f4281a97821e07ddc5d19ca9c163fdbeeb73",
        "e8b4b40ce77fe1c6b396712780f759e806aa4252d6177655c74c2f9e80b083db",
        "ee37bc3ccba61ff28a10c05f28bdabf7466db400a75d9a1890fb865cda23e145",
    ],
}
